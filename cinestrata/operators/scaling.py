"""Scaling and imputation with statistics fitted on one frame and applied to another."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations, combinations_with_replacement

from pyspark.sql import Column, DataFrame, functions as F


_STATS = "__stats"


def _with_stats(df: DataFrame, source: DataFrame, columns: Sequence[str],
                **aggregates) -> tuple[DataFrame, dict[str, dict[str, Column]]]:
    """``df`` with one struct of the source's aggregates, and the way to each of them."""
    row = source.agg(F.struct(*[
        agg(F.col(f"`{c}`").cast("double")).alias(f"{name}_{i}")
        for i, c in enumerate(columns) for name, agg in aggregates.items()]).alias(_STATS))
    found = {c: {name: F.col(f"{_STATS}.{name}_{i}") for name in aggregates}
             for i, c in enumerate(columns)}
    return df.select("*", row.scalar().alias(_STATS)), found


def _replaced(df: DataFrame, new: dict[str, Column], original: DataFrame) -> DataFrame:
    added = [c for c in new if c not in original.columns]
    return df.select(*[new[c].alias(c) if c in new else F.col(f"`{c}`")
                       for c in original.columns + added])


def minmax(df: DataFrame, column: str, name: str | None = None,
           fit_on: DataFrame | None = None) -> DataFrame:
    """Scale a column to 0..1 by its least and greatest value; no range gives NULL."""
    wide, stats = _with_stats(df, df if fit_on is None else fit_on, [column], lo=F.min, hi=F.max)
    s = stats[column]
    scaled = F.try_divide(F.col(column).cast("double") - s["lo"], s["hi"] - s["lo"])
    return _replaced(wide, {name or f"{column}_scaled": scaled}, df)


def standardize(train: DataFrame, apply_to: DataFrame, columns: Sequence[str],
                population: bool = True) -> DataFrame:
    """Z-scores with the train frame's mean and deviation; a constant column gives 0."""
    spread = F.stddev_pop if population else F.stddev_samp
    wide, stats = _with_stats(apply_to, train, columns, mean=F.avg, sd=spread)
    new = {}
    for c in columns:
        centred = F.col(f"`{c}`").cast("double") - stats[c]["mean"]
        new[c] = F.when(stats[c]["sd"] == 0, centred).otherwise(centred / stats[c]["sd"])
    return _replaced(wide, new, apply_to)


def impute_mean(train: DataFrame, apply_to: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fill NULLs with the train frame's mean."""
    wide, stats = _with_stats(apply_to, train, columns, mean=F.avg)
    return _replaced(wide, {
        c: F.coalesce(F.col(f"`{c}`").cast("double"), stats[c]["mean"]) for c in columns}, apply_to)


def product_terms(columns: Sequence[str], degree: int,
                  interactions_only: bool = False) -> list[tuple[str, ...]]:
    """All combinations of 1 to ``degree`` columns; ``interactions_only`` repeats none."""
    pick = combinations if interactions_only else combinations_with_replacement
    return [t for d in range(1, degree + 1) for t in pick(columns, d)]


def product_sql(term: Sequence[str]) -> str:
    """The product of a term's columns as SQL; hundreds of terms are one text to parse."""
    return " * ".join(f"cast(`{n}` as double)" for n in term)


def poly_expand(df: DataFrame, columns: Sequence[str], degree: int = 2,
                interactions_only: bool = False, keep: Sequence[str] = ()) -> DataFrame:
    """All products of up to ``degree`` of the columns, named ``a*b``, after ``keep``."""
    return df.selectExpr(*[f"`{k}`" for k in keep], *[
        f"{product_sql(t)} as `{'*'.join(t)}`"
        for t in product_terms(columns, degree, interactions_only)])


def poly_interactions(df: DataFrame, columns: Sequence[str], degree: int = 3,
                      keep: Sequence[str] = ()) -> DataFrame:
    """Products of different columns only."""
    return poly_expand(df, columns, degree, interactions_only=True, keep=keep)
