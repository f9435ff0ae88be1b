"""Comma-separated list columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from cinestrata.functions.bands import flag
from cinestrata.schema import NULL_TOKEN


def items(name: str) -> Column:
    """The list as an array of trimmed items; NULL, blank and sentinel give no items."""
    col = F.col(name)
    parts = F.transform(F.split(col, ","), lambda x: F.trim(x))
    return F.when(col.isNull() | (col == "") | (col == NULL_TOKEN),
                  F.array().cast("array<string>")).otherwise(parts)


def list_size(name: str, empty_is_zero: bool = False) -> Column:
    """Number of items; NULL counts 0. An empty text has one (empty) item by default."""
    col = F.col(name)
    none = col.isNull() | (col == "") if empty_is_zero else col.isNull()
    return F.when(none, F.lit(0)).otherwise(F.size(F.split(col, ",")))


def list_size_without(name: str, token: str = NULL_TOKEN) -> Column:
    """Number of items that are not ``token``; NULL and empty text count 0."""
    kept = F.filter(F.split(F.col(name), ","), lambda x: F.trim(x) != token)
    return F.when(F.col(name).isNull() | (F.col(name) == ""), F.lit(0)).otherwise(F.size(kept))


def first_item(name: str, missing: str = "Unknown") -> Column:
    """First item, trimmed; NULL and the sentinel give ``missing``."""
    col = F.col(name)
    return F.when(col.isNull() | (col == NULL_TOKEN), F.lit(missing)).otherwise(
        F.trim(F.split(col, ",")[0]))


def mentions(name: str, text: str, ignore_case: bool = False) -> Column:
    """0/1: the list text contains ``text`` anywhere (so Music also hits Musical)."""
    col, wanted = F.col(name), text
    if ignore_case:
        col, wanted = F.lower(col), text.lower()
    return flag(col.contains(wanted), null_as_zero=True)


def has_item(name: str, *wanted: str, ignore_case: bool = False) -> Column:
    """0/1: one whole item of the list equals one of ``wanted``."""
    parts = items(name)
    if ignore_case:
        parts = F.transform(parts, lambda x: F.lower(x))
        wanted = tuple(w.lower() for w in wanted)
    return flag(F.arrays_overlap(parts, F.array(*[F.lit(w) for w in wanted])), null_as_zero=True)


def column_suffix(label: str) -> str:
    """A label as part of a column name: hyphens and blanks become underscores."""
    return label.replace("-", "_").replace(" ", "_")
