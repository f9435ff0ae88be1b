"""Error measures, residual diagnostics and model comparison, as aggregates."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import combinations
from statistics import NormalDist

from pyspark.sql import Column, DataFrame, functions as F

from cinestrata.operators.quantiles import exact_quantiles
from cinestrata.operators.ranks import empirical_distance


def _residual(y: str, p: str) -> Column:
    return F.col(y) - F.col(p)


def metrics(df: DataFrame, y: str, p: str) -> DataFrame:
    """One row: rows, R², MSE, RMSE, MAE, all over the rows with both values."""
    e = _residual(y, p)
    mse = F.avg(e * e)
    return df.where(F.col(y).isNotNull() & F.col(p).isNotNull()).agg(
        F.count(e).alias("n"),
        (F.lit(1.0) - F.try_divide(mse, F.var_pop(y))).alias("r2"),
        mse.alias("mse"), F.sqrt(mse).alias("rmse"), F.avg(F.abs(e)).alias("mae"))


def median_abs_error(df: DataFrame, y: str, p: str) -> DataFrame:
    return exact_quantiles(df, F.abs(_residual(y, p)), [0.5]).select(
        F.col("value").alias("median_abs_error"))


def error_bands(df: DataFrame, y: str, p: str) -> DataFrame:
    """Share of predictions within half a point and one point; mean and greatest error."""
    e = F.col(p) - F.col(y)

    def within(limit: float) -> Column:
        return F.avg((F.abs(e) <= limit).cast("double")) * 100

    return df.agg(within(0.5).alias("within_half_pct"), within(1.0).alias("within_one_pct"),
                  F.avg(e).alias("mean_error"), F.max(F.abs(e)).alias("max_abs_error"))


def overfit_verdict(train: DataFrame, test: DataFrame) -> DataFrame:
    """Verdicts from the R² of two :func:`metrics` rows."""
    both = test.select(train.select("r2").scalar().alias("r2_train"),
                       F.col("r2").alias("r2_test"))
    gap = F.abs(F.col("r2_train") - F.col("r2_test"))
    return both.select(
        "r2_train", "r2_test", gap.alias("gap"),
        F.when(gap > 0.1, "overfitting")
        .when(F.greatest("r2_train", "r2_test") < 0.3, "underfitting")
        .otherwise("balanced").alias("verdict"),
        F.when(gap < 0.05, "none").when(gap < 0.10, "slight")
        .otherwise("strong").alias("overfit_level"))


def residual_stats(df: DataFrame, y: str, p: str) -> DataFrame:
    """Moments of the residuals; skew and excess kurtosis of the population."""
    r = _residual(y, p)
    median = exact_quantiles(df, r, [0.5]).select("value").scalar()
    return df.agg(
        F.avg(r).alias("mean"), F.stddev_samp(r).alias("std"), F.skewness(r).alias("skew"),
        F.kurtosis(r).alias("kurtosis"), F.min(r).alias("min"), F.max(r).alias("max"),
    ).withColumn("median", median)


def residual_outliers(df: DataFrame, y: str, p: str) -> DataFrame:
    """Rows beyond two and three deviations, and the share within one."""
    r = _residual(y, p)
    sd = df.agg(F.stddev_samp(r)).scalar()
    size = F.abs(F.col("r"))
    return df.select(r.alias("r"), sd.alias("sd")).agg(
        F.count_if(size > 2 * F.col("sd")).alias("beyond_2_sd"),
        F.count_if(size > 3 * F.col("sd")).alias("beyond_3_sd"),
        (F.avg((size <= F.col("sd")).cast("double")) * 100).alias("within_1_sd_pct"))


def scale_location(df: DataFrame, y: str, p: str) -> DataFrame:
    """Linear trend of the absolute residual over the prediction."""
    size = F.abs(_residual(y, p))
    return df.agg(F.regr_slope(size, F.col(p)).alias("slope"),
                  F.regr_intercept(size, F.col(p)).alias("intercept"))


def residual_histogram(df: DataFrame, y: str, p: str, bins: int = 50) -> DataFrame:
    """Equal-width bins with count, density and the fitted normal's density at the centre."""
    r = _residual(y, p)
    s = df.agg(F.struct(F.min(r).alias("lo"), F.max(r).alias("hi"), F.count(r).alias("n"),
                        F.avg(r).alias("mean"), F.stddev_samp(r).alias("sd"))).scalar()
    width = (F.col("s.hi") - F.col("s.lo")) / bins
    place = F.least(F.floor(F.try_divide(F.col("r") - F.col("s.lo"), width)), F.lit(bins - 1))
    filled = (df.select(r.alias("r"), s.alias("s")).where(F.col("r").isNotNull())
              .select(F.coalesce(place, F.lit(0)).cast("int").alias("bin"))
              .groupBy("bin").agg(F.count(F.lit(1)).alias("count")))
    every = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"),
                                               s.alias("s"))
    n = F.coalesce("count", F.lit(0))
    z = F.try_divide(F.col("s.lo") + width * (F.col("bin") + 0.5) - F.col("s.mean"),
                     F.col("s.sd"))
    bell = F.try_divide(F.exp(-z * z / 2), F.col("s.sd") * F.sqrt(F.lit(2.0) * F.pi()))
    # Both sides hold at most ``bins`` rows.
    return every.join(F.broadcast(filled), "bin", "left").select(
        "bin", (F.col("s.lo") + width * F.col("bin")).alias("lower"), n.alias("count"),
        F.try_divide(n.cast("double"), F.col("s.n") * width).alias("density"),
        bell.alias("normal_density"))


def residual_boxplot(df: DataFrame, y: str, p: str) -> DataFrame:
    """Quartiles, whiskers (last values within 1.5 IQR) and the number of outliers."""
    r = _residual(y, p)
    table = exact_quantiles(df, r, [0.25, 0.5, 0.75])

    def at(prob: float) -> Column:
        return F.max(F.when(F.col("prob") == prob, F.col("value")))

    q = table.agg(F.struct(at(0.25).alias("q1"), at(0.5).alias("median"),
                           at(0.75).alias("q3"))).scalar()
    reach = (F.col("q.q3") - F.col("q.q1")) * 1.5
    inside = F.col("r").between(F.col("q.q1") - reach, F.col("q.q3") + reach)
    return df.select(r.alias("r"), q.alias("q")).agg(
        *[F.any_value(f"q.{n}").alias(n) for n in ("q1", "median", "q3")],
        F.min(F.when(inside, F.col("r"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("r"))).alias("whisker_high"),
        F.count_if(~inside).alias("outliers"))


def qq_probabilities(points: int) -> list[float]:
    return [(i + 0.5) / points for i in range(points)]


def qq_points(df: DataFrame, y: str, p: str, points: int = 99) -> DataFrame:
    """Sample quantiles of the residuals beside the normal distribution's."""
    probs = qq_probabilities(points)
    normal = NormalDist()

    def numbers(values: list[float]) -> Column:
        return F.expr(f"array({', '.join(f'{v!r}D' for v in values)})")

    theory = F.map_from_arrays(numbers(probs), numbers([normal.inv_cdf(q) for q in probs]))
    return exact_quantiles(df, _residual(y, p), probs).select(
        "prob", F.element_at(theory, F.col("prob")).alias("theoretical"),
        F.col("value").alias("sample"))


def ks_test(df: DataFrame, y: str, p: str) -> DataFrame:
    """``n, statistic, p_value``: the residuals against the normal distribution fitted to them.

    The distance is exact; its probability is Kolmogorov's limit with Stephens's correction for n.
    """
    r = _residual(y, p)
    fit = df.agg(F.avg(r).alias("mean"), F.stddev_samp(r).alias("sd")).first()
    found = empirical_distance(df, r, F.lit(fit["mean"]), F.lit(fit["sd"]))
    size = F.expr("(sqrt(n) + 0.12 + 0.11 / sqrt(n)) * statistic")
    series = F.expr("aggregate(sequence(1, 100), 0D, (total, k) -> total + "
                    "2 * if(k % 2 = 1, 1, -1) * exp(-2 * k * k * size * size))")
    return found.withColumn("size", size).select("n", "statistic", F.when(
        F.col("size") < 0.2, 1.0).otherwise(
            F.least(F.lit(1.0), F.greatest(F.lit(0.0), series))).alias("p_value"))


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(a, b, corr)`` for every pair of columns, in one scan."""
    pairs = list(combinations(columns, 2))
    wide = df.agg(*[
        F.corr(F.col(f"`{a}`").cast("double"), F.col(f"`{b}`").cast("double")).alias(f"c{i}")
        for i, (a, b) in enumerate(pairs)])
    entries = F.array(*[
        F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"c{i}").alias("corr"))
        for i, (a, b) in enumerate(pairs)])
    return wide.select(F.inline(entries))


def compare_models(named: dict[str, DataFrame], baseline: str) -> DataFrame:
    """Metric rows of several models with improvement over the baseline and the best marked."""
    parts = [m.select(F.lit(name).alias("model"), "r2", "rmse", "mae")
             for name, m in named.items()]
    table = reduce(DataFrame.unionByName, parts)
    # Equal models differ in the last bits only; the name decides then.
    best = table.agg(F.max_by("model", F.struct(F.round("r2", 9), "model"))).scalar()
    base = table.where(F.col("model") == baseline).select("r2").scalar()
    gain = F.col("r2") - base
    return table.select(
        "model", "r2", "rmse", "mae", gain.alias("gain"),
        (F.try_divide(gain, base) * 100).alias("improvement_pct"),
        (F.col("model") == best).cast("int").alias("is_best"))
