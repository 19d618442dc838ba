"""Day facts: page views, unique and new visitors, addresses."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.functions.events import IS_NEW_PAGE_VIEW, IS_PAGE_VIEW
from footfall.operators.cube import ROLLED, Cube
from footfall.sources.log import EVENTS

ENTITY = ("kind", "entity")

# One event as the entities it names, each with the measures it brings.
ADDRESS = "struct(0 AS kind, client_ip AS entity, 0L AS pv, 0 AS uv, 0 AS new_uv, 1 AS ip_count)"
VISITOR = (
    f"struct(1 AS kind, distinct_id AS entity, {EVENTS} AS pv, 1 AS uv,"
    f" CAST({IS_NEW_PAGE_VIEW} AS INT) AS new_uv, 0 AS ip_count)"
)


def fact_cells(log: DataFrame, cube: Cube) -> DataFrame:
    """Cells of pv, uv, new_uv and ip_count.

    Each event names two entities: its address, and for a page view its visitor. Both take the
    same way through one distinct count, as rows of one kind or the other. Addresses count over
    all events, so every group of the day has `ip_count` of at least 1.
    """
    entities = f"inline(CASE WHEN {IS_PAGE_VIEW} THEN array({ADDRESS}, {VISITOR}) ELSE array({ADDRESS}) END)"
    seen = log.selectExpr(*cube.keys, *cube.columns, entities)
    flags, sums = ("uv", "new_uv", "ip_count"), ("pv",)
    leaves = (
        cube.leaves(seen, (*ENTITY, *flags, *sums))
        .groupBy(*cube.keys, ROLLED, *cube.columns, *ENTITY)
        .agg(*(F.max(flag).alias(flag) for flag in flags), F.sum("pv").alias("pv"))
    )
    return cube.distinct_cells(leaves, ENTITY, flags, sums)
