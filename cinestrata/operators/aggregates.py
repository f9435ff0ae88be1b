"""Frequencies, token counts, flag and NULL counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from cinestrata.functions.lists import items
from cinestrata.operators.ordering import top_n


def frequencies(df: DataFrame, column: str | Column, name: str = "value") -> DataFrame:
    """``(name, n)``: rows per value; NULL is not a value."""
    value = F.col(column) if isinstance(column, str) else column
    return (df.select(value.alias(name)).where(F.col(name).isNotNull())
            .groupBy(name).agg(F.count(F.lit(1)).alias("n")))


def value_counts(df: DataFrame, column: str | Column, name: str = "value") -> DataFrame:
    """Frequencies, most frequent first, ties by value."""
    return frequencies(df, column, name).orderBy(F.desc("n"), F.asc(name))


def last_keys(df: DataFrame, column: str | Column, k: int, name: str = "value") -> DataFrame:
    """Frequencies of the k greatest values, in ascending order."""
    return top_n(frequencies(df, column, name), [F.desc(name)], k).orderBy(name)


def tokens(df: DataFrame, column: str, name: str = "token") -> DataFrame:
    """One row per item of a comma list."""
    return df.select(F.explode(items(column)).alias(name))


def top_tokens(df: DataFrame, column: str, k: int) -> DataFrame:
    """The k most frequent items of a comma list, ties by item."""
    counts = frequencies(tokens(df, column), "token", "token")
    return top_n(counts, [F.desc("n"), F.asc("token")], k)


def top_names(df: DataFrame, column: str | Column, k: int, as_list: bool = False) -> list[str]:
    """The k most frequent items or values as names for new columns; k rows reach the driver."""
    if as_list:
        rows = top_tokens(df, column, k).collect()
        return [r["token"] for r in rows]
    counts = frequencies(df, column)
    return [r["value"] for r in top_n(counts, [F.desc("n"), F.asc("value")], k).collect()]


def distinct_tokens(df: DataFrame, column: str) -> DataFrame:
    """Number of different items of a comma list: dedupe first, then count."""
    return (tokens(df, column).distinct()
            .agg(F.count("token").alias("distinct_tokens")))


def _unpivot(one_row: DataFrame, columns: Sequence[str], name: str,
             fields: Sequence[str]) -> DataFrame:
    """One row per column from a row holding a struct of ``fields`` per column."""
    entries = F.array(*[
        F.struct(F.lit(c).alias(name), *[F.col(f"c{i}")[f].alias(f) for f in fields])
        for i, c in enumerate(columns)])
    return one_row.select(F.inline(entries))


def flag_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(flag, positives, pct)`` per 0/1 column, in one scan."""
    total = F.count(F.lit(1))
    wide = df.agg(*[
        F.struct(
            F.coalesce(F.sum(F.col(f"`{c}`").cast("bigint")), F.lit(0)).alias("positives"),
            F.try_divide(F.sum(F.col(f"`{c}`").cast("bigint")) * F.lit(100.0),
                         total.cast("double")).alias("pct"),
        ).alias(f"c{i}") for i, c in enumerate(columns)])
    return _unpivot(wide, columns, "flag", ("positives", "pct"))


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``(column, nulls)`` per column, in one scan."""
    names = list(columns) if columns is not None else df.columns
    wide = df.agg(*[
        F.struct(F.count_if(F.col(f"`{c}`").isNull()).alias("nulls")).alias(f"c{i}")
        for i, c in enumerate(names)])
    return _unpivot(wide, names, "column", ("nulls",))
