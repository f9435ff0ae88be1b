"""Feature columns of the refined layer, one mapping of name to expression per table.

A mapping keeps the features independent of each other: one ``select`` adds them
all, so the plan has one projection however many features a table has.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, functions as F

from cinestrata.functions.bands import Bands, flag, present
from cinestrata.functions.lists import (
    has_item, list_size, list_size_without, mentions)

Features = Mapping[str, Column]

# Labels and edges of every category column.
RATING_CATEGORY = Bands(
    ((4, "poor"), (6, "fair"), (7, "good"), (8, "very_good")),
    beyond="excellent", missing="excellent")
RATING_CATEGORY_BINNED = Bands(
    ((4, "poor"), (6, "fair"), (7, "good"), (8, "very_good"), (10, "excellent")), above=0)
DECADE_LABEL = Bands(
    ((1950, "classic"), (1980, "golden_age"), (2000, "modern")),
    beyond="contemporary", missing="unknown", closed=False)
RUNTIME_CATEGORY = Bands(
    ((30, "short"), (90, "standard"), (150, "long")), beyond="epic", missing="unknown")
CREW_CATEGORY = Bands(
    ((2, "small_crew"), (5, "medium_crew")), beyond="large_crew", exact=((0, "no_crew"),))
BILLING_POSITION = Bands(
    ((3, "main_cast"), (10, "supporting")), beyond="minor", missing="minor",
    exact=((1, "lead"),))
TITLE_PRIORITY = Bands(
    ((3, "secondary"),), beyond="alternative", missing="alternative", exact=((1, "primary"),))
SEASON_CATEGORY = Bands(
    ((3, "early_seasons"), (7, "mid_seasons")), beyond="later_seasons", missing="unknown",
    exact=((1, "first_season"),))
EPISODE_CATEGORY = Bands(
    ((5, "early_episode"), (10, "mid_episode")), beyond="later_episode", missing="unknown",
    exact=((1, "pilot"),))
EPISODE_POSITION = Bands(
    ((3, "beginning"), (19, "middle")), beyond="ending", missing="unknown")
FAME_CATEGORY = Bands(
    ((3, "established"),), beyond="celebrity", exact=((0, "unknown"), (1, "emerging")))
GENERATION = Bands(
    ((1930, "classic_era"), (1950, "golden_age"), (1970, "new_hollywood"), (1990, "modern_era")),
    beyond="contemporary", missing="unknown", closed=False)

# Title types and principal categories that get a column of their own.
TITLE_TYPES = ("movie", "tvSeries", "short", "tvMovie", "documentary")
PRINCIPAL_CATEGORIES = ("actor", "actress", "director", "writer", "producer")
ROLE_GROUPS = {
    "acting": ("actor", "actress"),
    "directing": ("director",),
    "producing": ("producer",),
    "writing": ("writer",),
    "music": ("composer",),
}


def with_features(df: DataFrame, features: Features) -> DataFrame:
    """Add the features in one projection; a feature replaces a column of its name."""
    kept = [F.col(f"`{c}`") for c in df.columns if c not in features]
    return df.select(*kept, *[expr.alias(name) for name, expr in features.items()])


def ratings(vote_threshold: Column | float | None = None, binned: bool = False) -> Features:
    """Rating features; ``is_popular`` only with a vote threshold to compare with."""
    votes, rating = F.col("numVotes"), F.col("averageRating")
    bands = RATING_CATEGORY_BINNED if binned else RATING_CATEGORY
    out = {
        "log_votes": F.log1p(votes),
        "rating_normalized": (rating - 1) / 9,
        "rating_category": bands.label(rating),
    }
    if vote_threshold is not None:
        out["is_popular"] = flag(votes >= vote_threshold)
    return out


def basics() -> Features:
    """The layer job's title features."""
    return {
        "title_length": F.length("primaryTitle"),
        "has_runtime": present("runtimeMinutes"),
        "has_end_year": present("endYear"),
        "is_adult": F.col("isAdult").try_cast("int"),
        "decade": DECADE_LABEL.label(F.col("startYear")),
        "runtime_category": RUNTIME_CATEGORY.label(F.col("runtimeMinutes")),
    }


def basics_compact(as_of_year: int) -> Features:
    """The second title variant, without the data-driven genre flags."""
    out = {
        "film_age": F.coalesce(F.lit(as_of_year) - F.col("startYear"), F.lit(0)),
        "has_runtime": present("runtimeMinutes"),
        "genre_count": list_size("genres", empty_is_zero=True),
    }
    out.update(title_type_flags())
    return out


def title_type_flags() -> Features:
    return {f"type_{t}": flag(F.col("titleType") == t, null_as_zero=True) for t in TITLE_TYPES}


def crew() -> Features:
    directors, writers = list_size("directors"), list_size("writers")
    team = directors + writers
    return {
        "num_directors": directors,
        "num_writers": writers,
        "has_director": present("directors"),
        "has_writer": present("writers"),
        "total_crew_size": team,
        "crew_category": CREW_CATEGORY.label(team),
    }


def crew_filtered() -> Features:
    """List sizes that ignore sentinel items."""
    return {"director_count": list_size_without("directors"),
            "writer_count": list_size_without("writers")}


def principals() -> Features:
    category, place = F.col("category"), F.col("ordering")
    acting = category.isin(*ROLE_GROUPS["acting"])
    group = F.lit(None).cast("string")
    for name, members in reversed(ROLE_GROUPS.items()):
        group = F.when(category.isin(*members), name).otherwise(group)
    return {
        "billing_position": BILLING_POSITION.label(place),
        "is_actor": flag(acting),
        "is_director": flag(category == "director"),
        "is_producer": flag(category == "producer"),
        "has_character": present("characters"),
        "has_job": present("job"),
        "is_main_cast": flag(place <= 5),
        "role_category": F.coalesce(group, F.lit("other")),
    }


def principals_onehot() -> Features:
    """The variant where an unknown ordering or category counts as 0."""
    out = {"is_lead_actor": flag(F.col("ordering") <= 3, null_as_zero=True)}
    for name in PRINCIPAL_CATEGORIES:
        out[f"is_{name}"] = flag(F.col("category") == name, null_as_zero=True)
    return out


def akas() -> Features:
    return {
        "title_length": F.length("title"),
        "has_region": present("region"),
        "has_language": present("language"),
        "is_original_title": flag(F.col("isOriginalTitle") == "1"),
        "has_attributes": present("attributes"),
        "title_priority": TITLE_PRIORITY.label(F.col("ordering")),
    }


def episode() -> Features:
    season, number = F.col("seasonNumber"), F.col("episodeNumber")
    return {
        "has_season_number": present("seasonNumber"),
        "has_episode_number": present("episodeNumber"),
        "season_category": SEASON_CATEGORY.label(season),
        "episode_category": EPISODE_CATEGORY.label(number),
        "episode_position": EPISODE_POSITION.label(number),
    }


def names(as_of_year: int) -> Features:
    born, died = F.col("birthYear"), F.col("deathYear")
    titles = list_size("knownForTitles")
    out = {
        "is_alive": flag(died.isNull()),
        "has_birth_year": present("birthYear"),
        "approximate_age": F.when(died.isNull(), F.lit(as_of_year) - born),
        "career_span": died - born,
        "name_length": F.length("primaryName"),
        "num_professions": list_size("primaryProfession"),
        "num_known_titles": titles,
    }
    actor, actress = (F.col("primaryProfession").contains(w) for w in ("actor", "actress"))
    out["is_actor"] = flag(actor | actress, null_as_zero=True)
    for role in ("director", "writer"):
        out[f"is_{role}"] = mentions("primaryProfession", role)
    out["fame_category"] = FAME_CATEGORY.label(titles)
    out["generation"] = GENERATION.label(born)
    return out


def names_role_items() -> Features:
    """Role flags on whole list items: an assistant director is no director."""
    return {
        "is_actor": has_item("primaryProfession", "actor", "actress"),
        "is_director": has_item("primaryProfession", "director"),
        "is_writer": has_item("primaryProfession", "writer"),
    }


def generic(columns: list[str]) -> Features:
    """Features any table can have: filled columns per row and key length."""
    filled = F.lit(0)
    for c in columns:
        filled = filled + present(c)
    return {"completeness_score": filled, "primary_key_length": F.length(columns[0])}


def extended(name: str, as_of_year: int, genres: list[str]) -> Features | None:
    """The second variant of a table's features, None for tables that have one variant.

    ``genres`` are the names that get a flag each, by substring as in the title's genre text.
    """
    if name == "basics":
        flags = {f"genre_{g.lower()}": mentions("genres", g) for g in genres}
        return {**basics_compact(as_of_year), **flags}
    return {"crew": crew_filtered, "principals": principals_onehot}.get(name, lambda: None)()


FEATURES: dict[str, Callable[[int], Features]] = {
    "basics": lambda year: basics(),
    "crew": lambda year: crew(),
    "principals": lambda year: principals(),
    "akas": lambda year: akas(),
    "episode": lambda year: episode(),
    "names": names,
}
