"""Feature columns of the model set (rated movies joined with their titles)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F

from cinestrata.functions.bands import Bands, flag
from cinestrata.functions.lists import column_suffix, first_item, has_item, list_size, mentions
from cinestrata.functions.tables import Features

# Labels and edges.
DURATION_CATEGORY = Bands(
    ((90, "short"), (120, "standard"), (180, "long"), (300, "epic")), above=0)
CINEMA_ERA = Bands(
    ((1960, "Golden_Age"), (1980, "New_Hollywood"), (2000, "Blockbuster_Era"),
     (2010, "Digital_Era")),
    beyond="Streaming_Era", missing="Streaming_Era", closed=False)
RATING_QUALITY = Bands(
    ((5, "Baixo (1-5)"), (7, "Médio (5-7)"), (10, "Alto (7-10)")), above=0)

# The fifteen genres of the fixed flag set.
COMMON_GENRES = (
    "Drama", "Comedy", "Action", "Horror", "Thriller",
    "Romance", "Crime", "Adventure", "Sci-Fi", "Fantasy",
    "Documentary", "Animation", "Biography", "Mystery", "War",
)


def decade(year: str = "startYear") -> Column:
    return (F.floor(F.col(year) / 10) * 10).cast("int")


def primary_genre() -> Column:
    return first_item("genres")


def duration_category() -> Column:
    return DURATION_CATEGORY.label(F.col("runtimeMinutes"))


def rating_quality() -> Column:
    return RATING_QUALITY.label(F.col("averageRating"))


def cinema_era() -> Column:
    return CINEMA_ERA.label(F.col("startYear"))


def movie_age(as_of_year: int) -> Column:
    return F.lit(as_of_year) - F.col("startYear")


def ages(as_of_year: int) -> Features:
    age = movie_age(as_of_year)
    return {
        "movie_age": age,
        "movie_age_squared": F.pow(age, F.lit(2)),
        "movie_age_log": F.log1p(age),
        "is_recent": flag(age <= 5, null_as_zero=True),
        "is_classic": flag(age >= 30, null_as_zero=True),
    }


def genre_flags(genres: Iterable[str], whole_items: bool = False,
                clean_names: bool = True) -> Features:
    """``has_<genre>`` columns; by substring unless ``whole_items``."""
    out = {}
    for g in genres:
        name = "has_" + (column_suffix(g) if clean_names else g)
        out[name] = (has_item("genres", g, ignore_case=True) if whole_items
                     else mentions("genres", g, ignore_case=True))
    return out


def num_genres() -> Column:
    return F.when(F.col("genres") == "\\N", F.lit(0)).otherwise(
        list_size("genres", empty_is_zero=True))


def interactions(columns: Iterable[str], as_of_year: int) -> Features:
    """Products of runtime and year with genre flags; 0 where a flag is absent."""
    have = set(columns)

    def times(value: str, genre_flag: str) -> Column:
        return F.col(value) * (F.col(genre_flag) if genre_flag in have else F.lit(0))

    runtime = F.col("runtimeMinutes")
    return {
        "runtime_x_action": times("runtimeMinutes", "has_Action"),
        "runtime_x_drama": times("runtimeMinutes", "has_Drama"),
        "runtime_x_comedy": times("runtimeMinutes", "has_Comedy"),
        "year_x_action": times("startYear", "has_Action"),
        "year_x_scifi": times("startYear", "has_Sci_Fi"),
        "runtime_squared": F.pow(runtime, F.lit(2)),
        "runtime_log": F.log1p(runtime),
        "votes_per_age": F.try_divide(
            F.col("numVotes").cast("double"), (movie_age(as_of_year) + 1).cast("double")),
    }


def proposed_flags() -> Features:
    year = F.col("startYear")
    short_horror = (mentions("genres", "horror", ignore_case=True) == 1) & (
        F.col("runtimeMinutes") < 90)
    return {
        "is_good": flag(F.col("averageRating") >= 7, null_as_zero=True),
        "year_squared": F.pow(year, F.lit(2)),
        "recession_period": flag(year.between(2008, 2010), null_as_zero=True),
        "streaming_era": flag(year > 2015, null_as_zero=True),
        "horror_x_short": flag(short_horror, null_as_zero=True),
    }
