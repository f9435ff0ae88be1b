"""The model set and its two feature matrices.

Statistics that look across rows (genre means, group counts, ranges, category lists)
come from ``fit_on``. Pass the training part there: fitting on all rows would leak
the target into the test part.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, functions as F

from cinestrata.functions import modelset
from cinestrata.functions.bands import flag
from cinestrata.functions.tables import with_features
from cinestrata.operators.aggregates import top_names
from cinestrata.operators.cleaning import filter_movies, filter_rated
from cinestrata.operators.columns import align_features, columns_with_prefix
from cinestrata.operators.encoding import (
    categories, decade_dummies, genre_dummies, last_decades, one_hot)
from cinestrata.operators.lookup import attach_stats, measured, with_group_stat
from cinestrata.operators.scaling import minmax
from cinestrata.schema import RUN_COLUMNS
from cinestrata.session import materialised

KEY = "tconst"
LABEL = "averageRating"

# The numeric columns of both matrices.
NUMERIC_V1 = ("startYear", "runtimeMinutes", "movie_age", "runtime_normalized")
NUMERIC_V2 = (
    "startYear", "runtimeMinutes", "movie_age", "runtime_normalized", "numVotes",
    "year_movie_count", "genre_avg_votes", "genre_avg_rating",
    "num_genres", "movie_age_squared", "movie_age_log",
    "is_recent", "is_classic", "runtime_squared", "runtime_log", "votes_per_age",
)
INTERACTIONS = ("runtime_x_action", "runtime_x_drama", "runtime_x_comedy",
                "year_x_action", "year_x_scifi")


def build_model_set(ratings: DataFrame, basics: DataFrame, min_votes: int = 100) -> DataFrame:
    """Rated movies: both filters run below the join. Run columns come from the ratings only."""
    movies = filter_movies(basics).drop(*RUN_COLUMNS)
    return filter_rated(ratings, min_votes).join(movies, KEY)


def _genre_stats() -> list[Column]:
    return [F.avg("numVotes").alias("genre_avg_votes"), F.avg(LABEL).alias("genre_avg_rating")]


def _first_genre(df: DataFrame) -> DataFrame:
    return df.withColumn("primary_genre", modelset.primary_genre())


def with_genre_stats(df: DataFrame, fit_on: DataFrame | None = None) -> DataFrame:
    """Average votes and rating of the first genre, attached to each row."""
    return with_group_stat(_first_genre(df), "primary_genre", _genre_stats(),
                           fit_on=None if fit_on is None else _first_genre(fit_on))


def _base(df: DataFrame, as_of_year: int, fit_on: DataFrame | None) -> DataFrame:
    return minmax(with_features(df, modelset.ages(as_of_year)), "runtimeMinutes",
                  "runtime_normalized", fit_on=fit_on)


def assemble_v1(df: DataFrame, as_of_year: int = 2024, genres: int = 10,
                fit_on: DataFrame | None = None) -> tuple[DataFrame, list[str]]:
    """Key, label and the first matrix: numbers, duration and first-genre indicators."""
    wide = _base(df, as_of_year, fit_on).withColumn(
        "duration_category", modelset.duration_category())
    wide = one_hot(wide, "duration_category", "duration", modelset.DURATION_CATEGORY.labels)
    wide = genre_dummies(wide, genres, fit_on)
    names = list(NUMERIC_V1) + [f"duration_{d}" for d in modelset.DURATION_CATEGORY.labels]
    names += columns_with_prefix(wide, "genre_")
    return align_features(wide, names, keep=[KEY, LABEL]), names


def assemble_v2(df: DataFrame, as_of_year: int = 2024, genres: int = 15, decades: int = 6,
                fit_on: DataFrame | None = None, use_votes: bool = True,
                keep: tuple[str, ...] = ()) -> tuple[DataFrame, list[str]]:
    """Key, label and the expanded matrix, NULLs as 0.

    ``use_votes=False`` leaves out what is known only after release.
    """
    # Vocabularies and statistics are short jobs over the same rows: written once, run together.
    with ThreadPoolExecutor(5) as pool:
        rows = pool.submit(materialised, df, "assembly")
        if fit_on is not None:
            fit_on = pool.submit(materialised, fit_on, "assembly-fit").result()
        df = rows.result()
        source = df if fit_on is None else fit_on
        named = pool.submit(top_names, source, "genres", genres, as_list=True)
        found_eras = pool.submit(
            categories, source.select(modelset.cinema_era().alias("era")), "era")
        found_decades = pool.submit(last_decades, source, decades)
        by_year = pool.submit(measured, source.where("startYear is not null").groupBy(
            "startYear").agg(F.count(F.lit(1)).alias("year_movie_count")), "startYear")
        by_genre = pool.submit(measured, _first_genre(source).groupBy("primary_genre").agg(
            *_genre_stats()), "primary_genre")
    eras, flags = found_eras.result(), modelset.genre_flags(named.result())

    wide = with_features(_base(df, as_of_year, fit_on), flags)
    wide = with_features(wide, modelset.interactions(wide.columns, as_of_year))
    wide = with_features(wide, {
        "num_genres": modelset.num_genres(),
        **{f"era_{e}": flag(modelset.cinema_era() == e) for e in eras}})
    wide = decade_dummies(wide, decades=found_decades.result())
    counts, size = by_year.result()
    wide = attach_stats(wide, counts, "startYear", size=size)
    stats, size = by_genre.result()
    wide = attach_stats(_first_genre(wide), stats, "primary_genre", size=size)

    names = [n for n in NUMERIC_V2
             if use_votes or n not in ("numVotes", "genre_avg_votes", "votes_per_age")]
    names += list(flags) + columns_with_prefix(wide, "era_", "decade_") + list(INTERACTIONS)
    names = list(dict.fromkeys(names))
    return align_features(wide, names, keep=[KEY, LABEL, *keep]), names


def to_vector(df: DataFrame, features: list[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=features, outputCol=out, handleInvalid="keep").transform(df)
