"""Cubes that add sums and exact distinct counts without multiplying what is shuffled.

A plain CUBE with distinct counts copies each event 2^n times per distinct column and shuffles the
copies. Here everything becomes *cells*: rows of dimension values with measures that add up.

* Rows are merged at full dimension level first, on the map side.
* A visitor (or address) is described by what all its dimension tuples of the day have in common. An
  axis on which they agree cannot merge any of them when it is rolled up: the count is the same kept
  or rolled up. It stays `open`, and only the axes on which they differ are rolled up here. Most
  visitors differ on none or one, so they give one or two cells instead of 2^n.
* What they have in common are minima and maxima, merged on the map side and joined back to the
  tuples. No visitor's tuples have to meet in one task: the join may be split where one visitor has
  very many, and the copies are merged by visitor, axes and values, spread over all of these.
* Cells are added up over entities, and only then copied for their open axes.
* With a detail axis, the tuples of an entity within one of its values, and later the cells of one value, are dealt to one task:
  as many as the plain axes allow, once they are merged. What is left to do needs no further shuffle there, so that copies are
  made and added up where they are, and only for axes on which the cells of that value differ. Copies for the others are what they
  were copied from, and are made last.

`rolled` has one bit per axis, 1 = rolled up. It, not a null or an empty text, tells the total
from a raw value. `open` has one bit per axis still to be both kept and rolled up.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.functions.events import literal
from footfall.functions.fields import Axis, Field
from footfall.model import ALL

ROLLED = "rolled"
OPEN = "open"


def _subsets(axes: int) -> str:
    """SQL array: for each set of axes, as bits, the array of its subsets."""
    sets = range(1 << axes)
    return "array(" + ", ".join(f"array({', '.join(str(m) for m in sets if m & s == m)})" for s in sets) + ")"


@dataclass(frozen=True)
class Cube:
    """Grouping sets: `keys` always kept, `axes` and `detail` each kept or rolled up.

    `detail` is an axis that may have very many values (page, search word, city). It is rolled up
    ahead of the others, so that a visitor's tuples are compared within one detail value: even a
    visitor id shared by a third of the log has there no more tuples than the plain axes allow.
    `second` is one more such axis, rolled up apart from the first.
    """

    keys: tuple[str, ...]
    axes: tuple[Axis, ...]
    detail: Axis | None = None
    second: Axis | None = None

    @property
    def details(self) -> tuple[Axis, ...]:
        return tuple(axis for axis in (self.detail, self.second) if axis)

    @property
    def all_axes(self) -> tuple[Axis, ...]:
        return (*self.axes, *self.details)

    @property
    def fields(self) -> tuple[Field, ...]:
        return tuple(field for axis in self.all_axes for field in axis.fields)

    @property
    def columns(self) -> tuple[str, ...]:
        return tuple(field.name for field in self.fields)

    def bit(self, axis: Axis) -> int:
        return 1 << self.all_axes.index(axis)

    @property
    def _every_axis(self) -> int:
        return (1 << len(self.axes)) - 1

    @property
    def _detail_columns(self) -> tuple[str, ...]:
        return tuple(name for axis in self.details for name in axis.columns)

    @property
    def _no_detail(self) -> int:
        """`rolled` of a row without any detail, bits of the plain axes left aside."""
        return sum(self.bit(axis) for axis in self.details)

    def _agreement(self, over: str = "") -> str:
        """SQL for the axes on which all rows put together agree, as bits. An axis of several columns agrees where all of them do."""
        return " + ".join(
            f"CASE WHEN {' AND '.join(f'min({name}) {over} = max({name}) {over}' for name in axis.columns)} THEN {self.bit(axis)} ELSE 0 END"
            for axis in self.axes
        )

    def _subsets_of(self, bits: str) -> str:
        return f"element_at({_subsets(len(self.axes))}, {bits} + 1)"

    def _roll(
        self, rows: DataFrame, axes: Sequence[Axis], masks: str, kept: Sequence[str], rolled: str = ROLLED
    ) -> DataFrame:
        """A copy of each row per mask, with the masked axes set to null; `kept` are other columns."""
        bits = {name: self.bit(axis) for axis in axes for name in axis.columns}
        copies = rows.selectExpr("*", f"explode({masks}) AS mask")
        return copies.selectExpr(
            *kept,
            *(f"CASE WHEN mask & {bits[n]} = 0 THEN {n} END AS {n}" if n in bits else n for n in self.columns),
            f"{rolled} | mask AS {ROLLED}",
        )

    def leaves(self, rows: DataFrame, kept: Sequence[str]) -> DataFrame:
        """Rows at full dimension level; with detail axes, also their copies without them."""
        if not self.details:
            return rows.selectExpr(*self.keys, *self.columns, *kept, f"0 AS {ROLLED}")
        whole = self._no_detail
        masks = [str(mask) for mask in range(whole + 1) if mask & whole == mask]
        return self._roll(rows, self.details, f"array({', '.join(masks)})", (*self.keys, *kept), "0")

    def distinct_cells(
        self,
        leaves: DataFrame,
        entity: Sequence[str],
        flags: Sequence[str],
        sums: Sequence[str] = (),
        keys: Sequence[str] = (),
    ) -> DataFrame:
        """Cells that count each entity once per group: flags by maximum, sums by sum.

        `leaves` are rows per (keys, dimension values, entity); `keys` are extra fixed keys.
        """
        fixed = (*self.keys, *keys)
        measures = (*flags, *sums)
        others = (*fixed, *entity, *measures, OPEN)

        def cells(compared: DataFrame) -> DataFrame:
            copies = self._roll(compared, self.axes, self._subsets_of(f"({self._every_axis} - {OPEN})"), others)
            return copies.groupBy(*fixed, OPEN, ROLLED, *self.columns, *entity).agg(
                *(F.max(flag).alias(flag) for flag in flags), *(F.sum(name).alias(name) for name in sums)
            )

        together = (*fixed, *self._detail_columns, *entity)
        if not self.details:
            return cells(self._with_open(leaves, together, measures))
        # Without any detail an entity may have all its tuples of the day; with one, those that meet in a value.
        whole = leaves.filter(f"{ROLLED} = {self._no_detail}")
        detailed = leaves.filter(f"{ROLLED} <> {self._no_detail}")
        over = f"OVER (PARTITION BY {', '.join(together)})"
        compared = detailed.selectExpr("*", f"{self._agreement(over)} AS {OPEN}")
        return cells(self._with_open(whole, together, measures)).unionByName(cells(compared))

    def _with_open(self, leaves: DataFrame, together: Sequence[str], measures: Sequence[str]) -> DataFrame:
        """The leaves with the axes on which all leaves of their entity agree, as bits.

        Both sides of the join read the same leaves, so they are computed once; that holds only while they use the same columns, which is why the entity's
        measures are carried along and compared (an entity has no less than one of its leaves).
        """
        # With a key that later groupings don't have, the tuples stay free to be dealt out anew after the join.
        named = leaves.withColumn("entity_hash", F.xxhash64(*together))
        described = (
            named.groupBy("entity_hash", *together)
            .agg(F.expr(f"{self._agreement()} AS {OPEN}"), *(F.max(name).alias(f"most_{name}") for name in measures))
            .withColumnsRenamed({name: f"same_{name}" for name in ("entity_hash", *together)})
        )
        # Nulls come from rolling the detail axis up; they are one value here.
        same = [f"{name} <=> same_{name}" for name in ("entity_hash", *together)]
        same += [f"coalesce({name} <= most_{name}, true)" for name in measures]
        joined = named.join(described, F.expr(" AND ".join(same)))
        return joined.select(*leaves.columns, OPEN)

    def open_cells(self, rows: DataFrame, measures: Sequence[str]) -> DataFrame:
        """Cells of rows whose measures simply add up."""
        return self.leaves(rows, measures).selectExpr("*", f"{self._every_axis} AS {OPEN}")

    def totals(self, cells: DataFrame, measures: Sequence[str]) -> DataFrame:
        """Add the cells up: one row per group, measures 0 where nothing was added."""

        def added(parts: DataFrame, *more: str) -> DataFrame:
            return parts.groupBy(*self.keys, *more, ROLLED, *self.columns).agg(
                *(F.expr(f"CAST(coalesce(sum({name}), 0) AS BIGINT) AS {name}") for name in measures)
            )

        merged = added(cells, OPEN)
        if not self.details:
            return added(self._roll(merged, self.axes, self._subsets_of(OPEN), (*self.keys, *measures)))
        # All copies of a cell stay in the task that has the cells of its detail. An axis on which those agree is open in all of them.
        # A fixed number of tasks: few large ones, as adaptive execution makes them by what they read, would hold all its copies at once.
        tasks = int(merged.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        dealt = merged.repartition(tasks, *self.keys, *self._detail_columns)
        over = f"OVER (PARTITION BY {', '.join((*self.keys, *self._detail_columns))}, {ROLLED} & {self._no_detail})"
        filled = " & ".join(
            f"CASE WHEN {' AND '.join(f'count({name}) {over} = count(1) {over}' for name in axis.columns)} THEN -1 ELSE {~self.bit(axis)} END"
            for axis in self.axes
        )
        agreed = f"({self._agreement(over)}) & ({filled}) & (bit_and({OPEN}) {over})"
        known = dealt.selectExpr("*", f"{agreed} AS agreed")
        copies = self._roll(known, self.axes, self._subsets_of(f"({OPEN} & ~agreed)"), (*self.keys, *measures, "agreed"))
        return self._roll(added(copies, "agreed"), self.axes, self._subsets_of("agreed"), (*self.keys, *measures), ROLLED)

    def report(self, totals: DataFrame, measures: Sequence[str]) -> DataFrame:
        """The totals with their dimension values as they read in the report."""
        labels = (
            f"CASE WHEN {ROLLED} & {self.bit(axis)} <> 0 THEN {literal(ALL)} ELSE {field.labelled()} END"
            f" AS {field.name}"
            for axis in self.all_axes
            for field in axis.fields
        )
        return totals.selectExpr(*self.keys, *labels, *measures)
