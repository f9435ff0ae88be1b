"""Features from the people behind a title."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cinestrata.functions.lists import items
from cinestrata.operators.lookup import attach_stats
from cinestrata.session import materialised


def director_fame(crew: DataFrame, ratings: DataFrame) -> DataFrame:
    """Average rating and vote sum per ``directors`` text, as one team."""
    return (crew.where(F.col("directors").isNotNull()).select("tconst", "directors")
            .join(ratings.select("tconst", "averageRating", "numVotes"), "tconst")
            .groupBy("directors")
            .agg(F.avg("averageRating").alias("director_avg_rating"),
                 F.sum("numVotes").alias("director_total_votes")))


def director_fame_exploded(crew: DataFrame, ratings: DataFrame) -> DataFrame:
    """The same figures per single director; the list is split after the join."""
    rated = (crew.select("tconst", "directors")
             .join(ratings.select("tconst", "averageRating", "numVotes"), "tconst"))
    return (rated.select(F.explode(items("directors")).alias("director"),
                         "averageRating", "numVotes")
            .groupBy("director")
            .agg(F.count(F.lit(1)).alias("titles"),
                 F.avg("averageRating").alias("director_avg_rating"),
                 F.sum("numVotes").alias("director_total_votes")))


def with_director_fame(movies: DataFrame, crew: DataFrame, ratings: DataFrame) -> DataFrame:
    """Movies with their directors' figures; a movie without directors keeps NULLs."""
    named = movies.join(crew.select("tconst", "directors"), "tconst", "left")
    return attach_stats(named, director_fame(crew, ratings), "directors")


def star_power(principals: DataFrame, ratings: DataFrame, k: int = 3) -> DataFrame:
    """Per title: mean, greatest and least average rating of its first k billed people.

    Repeated credits are counted before anything is shuffled for a join, and written once, since
    they are read again to be given their people's figures.
    """
    credits = materialised(
        principals.where(F.col("ordering") <= k)
        .groupBy("tconst", "nconst").agg(F.count(F.lit(1)).alias("credits")), "credits")
    rated = credits.join(ratings.where(F.col("averageRating").isNotNull())
                         .select("tconst", "averageRating"), "tconst")
    weighted = F.sum(F.col("credits") * F.col("averageRating"))
    people = rated.groupBy("nconst").agg((weighted / F.sum("credits")).alias("fame"))
    with_fame = attach_stats(credits, people, "nconst").where(F.col("fame").isNotNull())
    return with_fame.groupBy("tconst").agg(
        (F.sum(F.col("credits") * F.col("fame")) / F.sum("credits")).alias("avg_actor_fame"),
        F.max("fame").alias("max_actor_fame"), F.min("fame").alias("min_actor_fame"))
