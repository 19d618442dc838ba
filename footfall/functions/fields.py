"""Report dimensions: where they come from, what counts as unknown, how they read."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from footfall.functions.events import literal, one_of
from footfall.model import NOT_AVAILABLE
from footfall.sources.log import RAW


@dataclass(frozen=True)
class Field:
    """One report column taken from a log column.

    `unknown` are the raw values folded into N/A before grouping, `label` is what N/A reads as
    afterwards (None leaves it), `excluded` are values whose rows are dropped. Exclusion looks at
    the folded value, so an excluded '' has no effect once '' is folded.
    """

    name: str
    source: str | None = None
    unknown: tuple[str, ...] = ()
    label: str | None = ""
    excluded: tuple[str, ...] = ()

    def encoded(self) -> str:
        raw = self.source or self.name
        if not self.unknown:
            return raw
        return f"CASE WHEN {one_of(raw, self.unknown)} THEN {literal(NOT_AVAILABLE)} ELSE {raw} END"

    def labelled(self, blank: str = "") -> str:
        """The reading of a value that was not rolled up; `blank` is that of an empty one."""
        cases = f"WHEN {self.name} = '' THEN {literal(blank)} " if blank else ""
        if self.label is not None:
            cases += f"WHEN {self.name} = {literal(NOT_AVAILABLE)} THEN {literal(self.label)} "
        return f"CASE {cases}ELSE {self.name} END" if cases else self.name


@dataclass(frozen=True)
class Axis:
    """Fields that are rolled up together: usually one, for pages address, path and title."""

    fields: tuple[Field, ...]

    @property
    def columns(self) -> tuple[str, ...]:
        return tuple(field.name for field in self.fields)


def axis(*fields: Field) -> Axis:
    return Axis(fields)


def encode(rows: DataFrame, fields: Sequence[Field]) -> DataFrame:
    """Replace raw dimension values by their grouping values, ahead of any grouping.

    Spark resolves a grouping column to the input column, never to an alias of the same select
    list, so folding has to be a projection of its own.
    """
    changed = {field.name: field.encoded() for field in fields if field.encoded() != field.name}
    if changed:
        kept = [name for name in rows.columns if name not in changed]
        rows = rows.selectExpr(*kept, *(f"{value} AS {name}" for name, value in changed.items()))
    # Where '' is excluded as it stands, so is a null, and the condition can go to the scan.
    dropped = [
        f"NOT {one_of(f'{RAW}{field.name}' if '' in field.excluded and field.encoded() == field.name else field.name, field.excluded)}"
        for field in fields
        if field.excluded
    ]
    return rows.filter(" AND ".join(dropped)) if dropped else rows
