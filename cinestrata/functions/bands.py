"""Labelled value ranges, described as data and compiled to one CASE expression."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, functions as F


@dataclass(frozen=True)
class Bands:
    """Ascending ``(upper edge, label)`` steps over a numeric value.

    ``closed``      the upper edge belongs to its step (``<=``) or not (``<``)
    ``beyond``      label above the last edge, or None for NULL
    ``missing``     label of a NULL value
    ``above``       values not strictly greater than this have no label
    ``exact``       labels of single values, tested before the steps
    """

    steps: tuple[tuple[float, str], ...]
    beyond: str | None = None
    missing: str | None = None
    closed: bool = True
    above: float | None = None
    exact: tuple[tuple[float, str], ...] = ()

    @property
    def labels(self) -> list[str]:
        """Labels in ascending order of the value, without the NULL label."""
        names = [label for _, label in self.exact] + [label for _, label in self.steps]
        return names + ([self.beyond] if self.beyond else [])

    def label(self, value: Column) -> Column:
        nothing = F.lit(None).cast("string")
        case = F.when(value.isNull(), F.lit(self.missing).cast("string"))
        if self.above is not None:
            case = case.when(value <= self.above, nothing)
        for point, name in self.exact:
            case = case.when(value == point, name)
        for edge, name in self.steps:
            case = case.when(value <= edge if self.closed else value < edge, name)
        return case.otherwise(F.lit(self.beyond) if self.beyond else nothing)


def flag(condition: Column, null_as_zero: bool = False) -> Column:
    """A condition as 0/1; an unknown condition stays NULL unless asked otherwise."""
    bit = condition.cast("int")
    return F.coalesce(bit, F.lit(0)) if null_as_zero else bit


def present(name: str) -> Column:
    """1 where the column holds a value, else 0."""
    return flag(F.col(name).isNotNull())
