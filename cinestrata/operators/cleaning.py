"""RAW to TRUSTED: typed columns and row filters of each table."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

from cinestrata.schema import table
from cinestrata.sources.readers import cast_columns, null_sentinel


def filled(*names: str) -> Column:
    """Every named column holds a value that is not blank."""
    return reduce(and_, [F.trim(F.col(n)) != "" for n in names])


def _typed(df: DataFrame, name: str) -> DataFrame:
    return cast_columns(null_sentinel(df), table(name).types)


def _keyed(df: DataFrame, name: str) -> DataFrame:
    return _typed(df, name).where(filled(*table(name).required))


def clean_ratings(df: DataFrame) -> DataFrame:
    """Ratings from 1 to 10 with at least five votes; NULLs fail the test."""
    typed = cast_columns(df, table("ratings").types)
    return typed.where(F.col("averageRating").between(1, 10) & (F.col("numVotes") >= 5))


def clean_basics(df: DataFrame, strict: bool = False) -> DataFrame:
    """Titles with id, type and name; ``strict`` filters adult titles and old years instead."""
    typed = _typed(df, "basics")
    if strict:
        year = F.col("startYear")
        return typed.where((F.col("isAdult").try_cast("int") == 0)
                           & (year.isNull() | (year >= 1900)))
    return typed.dropna(subset=list(table("basics").required))


def clean_crew(df: DataFrame) -> DataFrame:
    return _keyed(df, "crew")


def clean_principals(df: DataFrame) -> DataFrame:
    return _keyed(df, "principals")


def clean_akas(df: DataFrame) -> DataFrame:
    return _keyed(df, "akas")


def clean_episode(df: DataFrame) -> DataFrame:
    return _keyed(df, "episode")


def clean_names(df: DataFrame) -> DataFrame:
    return _keyed(df, "names")


def clean_generic(df: DataFrame) -> DataFrame:
    """Any table: the first column is the key and must be filled."""
    return null_sentinel(df).where(filled(df.columns[0]))


CLEANERS = {
    "ratings": clean_ratings,
    "basics": clean_basics,
    "crew": clean_crew,
    "principals": clean_principals,
    "akas": clean_akas,
    "episode": clean_episode,
    "names": clean_names,
}


def drop_all_null(df: DataFrame) -> DataFrame:
    return df.dropna("all")


def drop_any_null(df: DataFrame) -> DataFrame:
    return df.dropna("any")


def filter_rated(df: DataFrame, min_votes: int = 100) -> DataFrame:
    """Ratings with enough votes for a model."""
    return df.where((F.col("numVotes") >= min_votes) & F.col("averageRating").between(1, 10))


def filter_movies(df: DataFrame) -> DataFrame:
    """Movies of 1980 to 2023, one to five hours long, with a genre."""
    return df.where(
        (F.col("titleType") == "movie")
        & F.col("startYear").between(1980, 2023)
        & F.col("runtimeMinutes").between(60, 300)
        & (F.col("genres") != "\\N"))
