"""Choosing, filling and aligning columns; metadata work only, no shuffle."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, functions as F, types as T

from cinestrata.sources.audit import numeric_columns


def drop_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    return df.drop(*names)


def drop_columns_matching(df: DataFrame, include: Sequence[str] = ("name", "link", "index"),
                          keep: Sequence[str] = ("likes",)) -> DataFrame:
    """Drop columns whose name contains one of ``include``, unless it contains one of ``keep``."""
    def unwanted(name: str) -> bool:
        return (any(part in name for part in include)
                and not any(part in name for part in keep))

    return df.select(*[F.col(f"`{c}`") for c in df.columns if not unwanted(c)])


def select_numeric(df: DataFrame) -> DataFrame:
    return df.select(*numeric_columns(df))


def columns_with_prefix(df: DataFrame, *prefixes: str) -> list[str]:
    """Column names with one of the prefixes, each once, in the table's order."""
    return [c for c in df.columns if c.startswith(prefixes)]


def fill_zero(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return df.fillna(0, subset=list(columns) if columns is not None else None)


def fill_na_string(df: DataFrame, token: str = "na") -> DataFrame:
    """NULL text becomes ``token``; other types stay."""
    return df.fillna(token)


def align_features(df: DataFrame, features: Sequence[str],
                   keep: Sequence[str] = ()) -> DataFrame:
    """Exactly ``features`` in that order after ``keep``: absent or NULL values are 0."""
    have = set(df.columns)
    return df.select(*keep, *[
        (F.coalesce(F.col(f"`{f}`").cast("double"), F.lit(0.0)) if f in have
         else F.lit(0.0)).alias(f)
        for f in features])


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
