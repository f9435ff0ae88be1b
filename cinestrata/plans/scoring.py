"""Batch scoring and the rankings built on predictions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from cinestrata.functions.lists import first_item
from cinestrata.functions.tables import RATING_CATEGORY
from cinestrata.operators.aggregates import frequencies
from cinestrata.operators.ordering import top_n
from cinestrata.plans.models import cross_validated, load_model
from cinestrata.schema import SCORING_REQUEST

# Texts of the opportunity verdicts.
REASON_YES = "Alto rating predito com baixa popularidade"
REASON_NO = "Não atende critérios de oportunidade"


def confidence(prediction: Column, r2_cv: float) -> Column:
    """The model's cross-validated R², raised in the middle of the scale, lowered outside."""
    factor = F.when(prediction.between(4, 8), F.lit(1.1)).otherwise(F.lit(0.9))
    return F.round(F.least(F.lit(r2_cv) * factor, F.lit(0.95)), 3)


def opportunity(prediction: Column, log_votes: Column, is_popular: Column) -> Column:
    """Struct of score, level and reason; missing votes count as 5.0, missing popularity as 0."""
    votes = F.coalesce(log_votes, F.lit(5.0))
    fits = (prediction >= 7) & (F.coalesce(is_popular, F.lit(0)) == 0)
    raw = F.try_divide(prediction, votes) * 100
    level = F.when(raw > 1.5, "HIGH").when(raw.isNotNull(), "MEDIUM")
    return F.struct(
        F.when(fits, F.round(raw, 2)).otherwise(F.lit(0.0)).alias("score"),
        F.when(fits, level).otherwise(F.lit("LOW")).alias("level"),
        F.when(fits, F.lit(REASON_YES)).otherwise(F.lit(REASON_NO)).alias("reason"))


def requests(df: DataFrame, column: str) -> DataFrame:
    """One row per movie of JSON scoring requests, with the other columns kept.

    Numbers stay as they were written, so that scoring can tell a bad one from a missing one.
    """
    others = [c for c in df.columns if c != column]
    parsed = df.select(*others, F.from_json(column, SCORING_REQUEST).alias("request"))
    return parsed.select(*others, F.inline("request.movies"))


def _feature(df: DataFrame, name: str) -> tuple[Column, Column]:
    """(value, broken) of one model feature; indicators come from their category column."""
    for prefix, source in (("cat_", "rating_category"), ("pop_", "is_popular")):
        if name.startswith(prefix) and name not in df.columns and source in df.columns:
            hit = F.col(source).cast("string") == name[len(prefix):]
            return F.coalesce(hit.cast("double"), F.lit(0.0)), F.lit(False)
    if name not in df.columns:
        return F.lit(0.0), F.lit(False)
    value = F.col(f"`{name}`").try_cast("double")
    return F.coalesce(value, F.lit(0.0)), F.col(f"`{name}`").isNotNull() & value.isNull()


def score(df: DataFrame, model, r2_cv: float, features: Sequence[str],
          keep: Sequence[str] = ("tconst",)) -> DataFrame:
    """Predictions with confidence, category and opportunity; a bad row says what is wrong."""
    prepared = {f: _feature(df, f) for f in features}
    broken = F.concat_ws(", ", *[F.when(bad, F.lit(f)) for f, (_, bad) in prepared.items()])
    have = set(df.columns)
    votes = F.col("log_votes").try_cast("double") if "log_votes" in have else F.lit(None)
    popular = F.col("is_popular").try_cast("int") if "is_popular" in have else F.lit(None)
    ready = df.select(
        *keep, votes.cast("double").alias("__votes"), popular.cast("int").alias("__popular"),
        F.when(broken != "", F.concat(F.lit("not a number: "), broken)).alias("error"),
        *[value.alias(f) for f, (value, _) in prepared.items() if f not in keep])
    scored = model.transform(ready)
    p, good = F.col("prediction"), F.col("error").isNull()
    chance = opportunity(p, F.col("__votes"), F.col("__popular"))
    results = {
        "predicted_rating": F.round(p, 2),
        "confidence": confidence(p, r2_cv),
        "rating_category": RATING_CATEGORY.label(p),
        "opportunity_score": chance["score"],
        "opportunity_level": chance["level"],
        "opportunity_reason": chance["reason"],
    }
    return scored.select(*keep, *[F.when(good, c).alias(n) for n, c in results.items()], "error")


def score_saved(df: DataFrame, path: str, keep: Sequence[str] = ("tconst",)) -> DataFrame:
    """:func:`score` by a saved model: features, R² and timestamp come from what lies beside it.

    Adds ``model_timestamp`` and, where a row has an error, the row itself as JSON (``record``).
    """
    model, info = load_model(df.sparkSession, path)
    record = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]))
    rows = df.withColumn("__record", record)
    scored = score(rows, model, cross_validated(info), info["features"], [*keep, "__record"])
    return scored.select(
        *[c for c in scored.columns if c != "__record"],
        F.when(F.col("error").isNotNull(), F.col("__record")).alias("record"),
        F.lit(info.get("timestamp")).cast("string").alias("model_timestamp"))


def _undervalued(scored: DataFrame, min_gap: float, max_rating: float,
                 min_votes: int) -> DataFrame:
    gap = F.col("predicted_rating") - F.col("actual_rating")
    return scored.withColumn("rating_diff", gap).where(
        (F.col("rating_diff") > min_gap) & (F.col("actual_rating") < max_rating)
        & (F.col("numVotes") >= min_votes))


def undervalued(scored: DataFrame, min_gap: float = 0.5, max_rating: float = 7.0,
                min_votes: int = 500, n: int | None = None) -> DataFrame:
    """Titles predicted clearly above their rating, widest gap first; n rows when given."""
    found = _undervalued(scored, min_gap, max_rating, min_votes)
    order = [F.desc("rating_diff"), F.asc("tconst")]
    return found.orderBy(*order) if n is None else top_n(found, order, n)


def undervalued_summary(scored: DataFrame, k: int = 5, **limits) -> DataFrame:
    """The k most frequent first genres among undervalued titles, with overall averages."""
    found = _undervalued(scored, **{"min_gap": 0.5, "max_rating": 7.0, "min_votes": 500, **limits})
    s = found.agg(F.struct(
        F.avg("rating_diff").alias("gap"), F.avg("actual_rating").alias("actual"),
        F.avg("predicted_rating").alias("predicted"))).scalar()
    genres = top_n(frequencies(found, first_item("genres"), "genre"),
                   [F.desc("n"), F.asc("genre")], k)
    return genres.select(
        "genre", "n", s["gap"].alias("avg_rating_diff"),
        s["actual"].alias("avg_actual_rating"), s["predicted"].alias("avg_predicted_rating"))


def gap_summary(scored: DataFrame) -> DataFrame:
    """Mean gap between prediction and rating, and the two signs on their own."""
    gap = F.col("predicted_rating") - F.col("actual_rating")
    return scored.agg(
        F.avg(gap).alias("mean_gap"),
        F.count_if(gap > 0).alias("positive"), F.count_if(gap < 0).alias("negative"),
        F.avg(F.when(gap > 0, gap)).alias("mean_positive"),
        F.avg(F.when(gap < 0, gap)).alias("mean_negative"))


def budget_ratio(df: DataFrame, best: bool = True, n: int = 10, key: str = "movie_id",
                 prediction: str = "score_previsto") -> DataFrame:
    """Budget in millions per predicted point: the n least (best) or greatest ratios."""
    ratio = F.try_divide(F.col("budget") / 1_000_000, F.col(prediction))
    ranked = df.select(key, "movie_title", "budget", prediction, ratio.alias("ratio"))
    first = F.asc("ratio") if best else F.desc("ratio")
    return top_n(ranked, [first, F.asc(key)], n, where=F.col("ratio").isNotNull())
