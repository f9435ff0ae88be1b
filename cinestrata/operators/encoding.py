"""Indicator columns for categories."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from cinestrata.functions.bands import flag
from cinestrata.functions.modelset import decade, primary_genre
from cinestrata.operators.aggregates import last_keys, top_names


def categories(df: DataFrame, column: str) -> list:
    """The distinct values of a column known to have few, in ascending order."""
    found = df.select(column).where(F.col(column).isNotNull()).distinct().collect()
    return sorted(r[0] for r in found)


def one_hot(df: DataFrame, column: str, prefix: str, values: Sequence,
            drop_first: bool = False) -> DataFrame:
    """Add one 0/1 column ``prefix_value`` per named value; NULL has no indicator.

    Values become columns, so the caller names them; :func:`one_hot_vector` takes a column of
    any number of values.
    """
    names = list(values)
    if drop_first:
        names = names[1:]
    return df.select("*", *[
        flag(F.col(column) == v, null_as_zero=True).alias(f"{prefix}_{v}") for v in names])


def genre_dummies(df: DataFrame, k: int = 10, fit_on: DataFrame | None = None) -> DataFrame:
    """Indicators of the k most frequent first genres."""
    genres = top_names(df if fit_on is None else fit_on, primary_genre(), k)
    return df.select("*", *[
        flag(primary_genre() == g, null_as_zero=True).alias(f"genre_{g}") for g in genres])


def last_decades(df: DataFrame, k: int = 6) -> list[int]:
    return [r["value"] for r in last_keys(df, decade(), k).collect()]


def decade_dummies(df: DataFrame, k: int = 6, fit_on: DataFrame | None = None,
                   decades: Sequence[int] | None = None) -> DataFrame:
    """Indicators of the last k decades, or of the named ones."""
    if decades is None:
        decades = last_decades(df if fit_on is None else fit_on, k)
    return df.select("*", *[
        flag(decade() == y, null_as_zero=True).alias(f"decade_{y}") for y in decades])


def one_hot_vector(train: DataFrame, column: str, out: str):
    """A fitted pipeline that turns a text column into a sparse indicator vector."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import OneHotEncoder, StringIndexer

    index = f"{out}__index"
    return Pipeline(stages=[
        StringIndexer(inputCol=column, outputCol=index, handleInvalid="keep",
                      stringOrderType="alphabetAsc"),
        OneHotEncoder(inputCol=index, outputCol=out, handleInvalid="keep"),
    ]).fit(train)
