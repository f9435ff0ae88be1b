"""The named reports over refined ratings and titles."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cinestrata.functions import tables
from cinestrata.functions.bands import Bands
from cinestrata.functions.tables import with_features
from cinestrata.operators.ordering import sample_n, top_n
from cinestrata.operators.quantiles import quantile


def refine_ratings(trusted: DataFrame, popular_share: float = 0.8,
                   binned: bool = False) -> DataFrame:
    """Trusted ratings with all features; popular means at or above the vote quantile."""
    threshold = quantile(trusted, "numVotes", popular_share)
    return with_features(trusted, tables.ratings(threshold, binned))


def top_movies(ratings: DataFrame, basics: DataFrame, min_votes: int = 50_000,
               min_rating: float = 8.5, n: int = 10) -> DataFrame:
    """Best-known movies among the well rated ones."""
    rated = ratings.where((F.col("numVotes") >= min_votes)
                          & (F.col("averageRating") >= min_rating))
    movies = basics.where(F.col("titleType") == "movie")
    return top_n(rated.join(movies, "tconst"), [F.desc("numVotes"), F.asc("tconst")], n,
                 columns=["tconst", "primaryTitle", "averageRating", "numVotes", "startYear"])


def movies_by_category(refined: DataFrame, min_votes: int = 10) -> DataFrame:
    """Counts and rating figures per rating category, best category first."""
    rating = F.col("averageRating")
    return (refined.where(rating.isNotNull() & (F.col("numVotes") >= min_votes))
            .groupBy("rating_category")
            .agg(F.count(F.lit(1)).alias("total_movies"), F.avg(rating).alias("avg_rating"),
                 F.avg("numVotes").alias("avg_votes"), F.max(rating).alias("max_rating"),
                 F.min(rating).alias("min_rating"))
            .orderBy(F.desc("avg_rating"), "rating_category"))


def sample_ratings(refined: DataFrame, min_rating: float = 7.0, min_votes: int = 1000,
                   n: int = 100) -> DataFrame:
    """The most voted among well rated titles."""
    keep = (F.col("averageRating") >= min_rating) & (F.col("numVotes") >= min_votes)
    columns = ["tconst", "averageRating", "numVotes", "log_votes", "rating_category",
               "is_popular"]
    if "ingestion_timestamp" in refined.columns:
        columns.append("ingestion_timestamp")
    return top_n(refined, [F.desc("numVotes"), F.asc("tconst")], n, where=keep, columns=columns)


# The opportunity levels of titles that are not popular.
OPPORTUNITY_LEVEL = Bands(((7, "LOW"), (8, "MEDIUM")), beyond="HIGH", missing="LOW", closed=False)


def opportunities(refined: DataFrame, n: int = 50, min_rating: float = 6.5,
                  votes: tuple[int, int] = (50, 10_000)) -> DataFrame:
    """Well rated titles few people voted on, by rating per log vote."""
    rating = F.col("averageRating")
    level = F.when(F.col("is_popular") == 0, OPPORTUNITY_LEVEL.label(rating)).otherwise("LOW")
    ratio = F.round(F.try_divide(rating, F.col("log_votes")), 4)
    keep = (rating >= min_rating) & F.col("numVotes").between(*votes)
    scored = refined.where(keep).select(
        "tconst", "averageRating", "numVotes", "log_votes", "rating_category",
        ratio.alias("opportunity_ratio"), level.alias("opportunity_level"))
    return top_n(scored, [F.desc("opportunity_ratio"), F.asc("tconst")], n)


def training_extract(refined: DataFrame, n: int = 100_000, min_votes: int = 10) -> DataFrame:
    """A reproducible random sample of rated titles with numeric codes."""
    codes = {label: i for i, label in enumerate(tables.RATING_CATEGORY.labels, start=1)}
    category = F.col("rating_category")
    encoded = F.coalesce(*[F.when(category == k, F.lit(v)) for k, v in codes.items()], F.lit(0))
    rated = refined.where((F.col("numVotes") >= min_votes)
                          & F.col("averageRating").between(1, 10))
    ts = F.col("ingestion_timestamp")
    return sample_n(rated, n, "tconst").select(
        "tconst", F.col("averageRating").alias("target_rating"), "numVotes", "log_votes",
        "rating_normalized", encoded.alias("rating_category_encoded"), "is_popular",
        F.year(ts).alias("ingestion_year"), F.month(ts).alias("ingestion_month"))
