"""Quantiles.

``percentile`` keeps every distinct value of the column in one aggregation buffer.
Here the values stay distributed: equal values are counted first, a histogram of
bounded size tells which bins hold the wanted ranks, a second one cuts those bins
finer, and only the distinct values of the cut are ordered.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

# Bins per power of two: some ten thousand for usual columns, and a bounded number for
# any column of doubles, so one task can add the histogram up.
_PER_OCTAVE = 256
_OFFSET = 1100 * _PER_OCTAVE  # above any exponent of a double
# Equal parts each bin with a wanted rank is cut into.
_PARTS = 4096


def number_bin(x: Column) -> Column:
    """An integer that never decreases as ``x`` grows, with constant relative width.

    It is never NULL, which keeps the join on it from adding a filter below the counts:
    so both uses of the counts have the same plan and share one shuffle.
    """
    octave = F.least(F.log2(F.abs(x)), F.lit(1025.0))  # infinity comes after every number
    size = F.coalesce(F.floor(octave * _PER_OCTAVE) + _OFFSET, F.lit(0)).cast("bigint")
    return F.when(x == 0, F.lit(0).cast("bigint")).when(x < 0, -size).otherwise(size)


def exact_quantiles(df: DataFrame, column: str | Column, probabilities: Sequence[float],
                    weight: str | None = None) -> DataFrame:
    """``(prob, value)``: linearly interpolated quantiles of the column's numbers.

    With ``weight`` a row stands for that many equal ones. However many probabilities there
    are, a value takes part once: wanted ranks travel as arrays with their bins.
    """
    source = F.col(column) if isinstance(column, str) else column
    rows = F.lit(1) if weight is None else F.col(weight)
    counts = (df.select(source.cast("double").alias("x"), rows.alias("n"))
              .where(F.col("x").isNotNull() & ~F.isnan("x"))
              .groupBy("x").agg(F.sum("n").alias("n")))
    binned = counts.select("x", "n", number_bin(F.col("x")).alias("bin"))

    upto = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    histogram = binned.groupBy("bin").agg(
        F.sum("n").alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi"))
    running = histogram.select(
        "bin", "lo", "hi", (F.sum("n").over(upto) - F.col("n")).alias("before"),
        F.col("n"), F.sum("n").over(Window.partitionBy()).alias("total"))

    def holding(wanted: Column) -> Column:
        """The wanted ranks just below or just above which lie from ``before`` on, ``n`` of them."""
        first, last = F.col("before"), F.col("before") + F.col("n")

        def inside(rank: Column) -> Column:
            return (rank >= first) & (rank < last)

        return F.filter(wanted, lambda w: inside(F.floor(w["position"]))
                        | inside(F.ceil(w["position"])))

    probs = F.expr(f"array({', '.join(f'{float(p)!r}D' for p in probabilities)})")
    wanted = F.transform(probs, lambda p, i: F.struct(
        i.alias("target"), p.alias("prob"), (p * (F.col("total") - 1)).alias("position")))
    bins = running.select("bin", "lo", "hi", F.col("before").alias("start"),
                          holding(wanted).alias("wanted")).where(F.size("wanted") > 0)

    # At most two bins per probability: small enough to broadcast by construction.
    share = F.try_divide(F.col("x") - F.col("lo"), F.col("hi") - F.col("lo"))
    inside = binned.join(F.broadcast(bins), "bin").select(
        "bin", "start", "wanted", "x", "n",
        F.coalesce(F.floor(share * (_PARTS - 1)), F.lit(0)).cast("bigint").alias("part"))
    within = Window.partitionBy("bin").orderBy("part").rowsBetween(Window.unboundedPreceding, 0)
    parts = (inside.groupBy("bin", "part").agg(
        F.sum("n").alias("n"), F.any_value("start").alias("start"),
        F.any_value("wanted").alias("wanted"))
        .withColumn("before", F.col("start") + F.sum("n").over(within) - F.col("n"))
        .select("bin", "part", "before", holding(F.col("wanted")).alias("wanted"))
        .where(F.size("wanted") > 0))

    # Of each part its distinct values are ordered, and each value keeps the ranks it holds.
    order = (Window.partitionBy("bin", "part").orderBy("x")
             .rowsBetween(Window.unboundedPreceding, 0))
    few = inside.select("bin", "part", "x", "n").join(F.broadcast(parts), ["bin", "part"])
    reached = few.select("x", "n", "wanted", (
        F.col("before") + F.sum("n").over(order) - F.col("n")).alias("before"))
    each = reached.select("x", "n", "before", F.inline(holding(F.col("wanted"))))

    def value(rank: Column) -> Column:
        return F.min(F.when((rank >= F.col("before")) & (rank < F.col("before") + F.col("n")),
                            F.col("x")))

    lower, upper = value(F.floor("position")), value(F.ceil("position"))
    fraction = F.any_value(F.col("position") - F.floor("position"))
    return each.groupBy("target").agg(
        F.any_value("prob").alias("prob"),
        F.when(lower == upper, lower).otherwise(lower + (upper - lower) * fraction)
        .alias("value")).drop("target")


def quantile(df: DataFrame, column: str | Column, probability: float) -> Column:
    """One exact quantile as a scalar subquery, usable in any expression."""
    return exact_quantiles(df, column, [probability]).select("value").scalar()


def approx_quantile(df: DataFrame, column: str, probability: float,
                    error: float = 0.01) -> DataFrame:
    """One quantile within ``error`` of its rank, from a sketch of bounded size."""
    return df.agg(F.percentile_approx(
        column, probability, max(1, round(1 / error))).alias("value"))
