"""Ranks over a whole table: values are ordered by range partitions, partitions by offsets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from cinestrata.session import materialised


def value_ranks(df: DataFrame, column: str | Column) -> DataFrame:
    """``value, n, below``: each number of the column, its rows, and the rows of smaller ones.

    Equal values are counted first, so a frequent value is one row. The distinct values are
    range-partitioned and written with their partition's number; each partition sums up by
    itself and is shifted by the rows of the partitions before it, a table of one row per
    partition. No task sees all values. NULL and NaN have no rank.
    """
    source = F.col(column) if isinstance(column, str) else column
    counts = (df.select(source.cast("double").alias("value"))
              .where(F.col("value").isNotNull() & ~F.isnan("value"))
              # -0.0 and 0.0 are one value.
              .groupBy((F.col("value") + 0.0).alias("value"))
              .agg(F.count(F.lit(1)).alias("n")))
    placed = materialised(counts.repartitionByRange("value").select(
        "value", "n", F.spark_partition_id().alias("part")), "ranks")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # As many rows as partitions.
    offsets = placed.groupBy("part").agg(F.sum("n").alias("rows")).select(
        "part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"))
    within = (Window.partitionBy("part").orderBy("value")
              .rowsBetween(Window.unboundedPreceding, -1))
    local = placed.select("part", "value", "n",
                          F.coalesce(F.sum("n").over(within), F.lit(0)).alias("here"))
    return local.join(F.broadcast(offsets), "part").select(
        "value", "n", (F.col("offset") + F.col("here")).alias("below"))


# The rational approximation of the normal distribution's tail (Hart 1968, no. 5666).
_ABOVE = (0.0352624965998911, 0.700383064443688, 6.37396220353165, 33.912866078383,
          112.079291497871, 221.213596169931, 220.206867912376)
_UNDER = (0.0883883476483184, 1.75566716318264, 16.064177579207, 86.7807322029461,
          296.564248779674, 637.333633378831, 793.826512519948, 440.413735824752)
_TAIL_FROM = 7.07106781186547


def normal_cdf(x: str) -> str:
    """The standard normal distribution function of an SQL expression, as SQL of any engine.

    Right to about 1e-15; beyond seven deviations by a continued fraction.
    """
    def polynomial(coefficients: tuple[float, ...]) -> str:
        text = repr(coefficients[0])
        for c in coefficients[1:]:
            text = f"({text} * abs({x}) + {c!r})"
        return text

    bell = f"exp(-({x}) * ({x}) / 2)"
    fraction = f"(abs({x}) + 0.65)"
    for k in (4, 3, 2, 1):
        fraction = f"(abs({x}) + {k} / {fraction})"
    tail = (f"case when abs({x}) < {_TAIL_FROM!r} then {bell} * {polynomial(_ABOVE)} / "
            f"{polynomial(_UNDER)} else {bell} / {fraction} / sqrt(2 * pi()) end")
    return f"case when {x} > 0 then 1 - ({tail}) else {tail} end"


def empirical_distance(df: DataFrame, column: str | Column, mean: Column, sd: Column) -> DataFrame:
    """``n, statistic``: the greatest distance of the empirical from a normal distribution.

    The empirical distribution jumps at each value, so both sides of the jump are compared.
    """
    ranks = value_ranks(df, column)
    total = ranks.agg(F.sum("n").cast("double")).scalar()
    scored = ranks.select("n", "below", ((F.col("value") - mean) / sd).alias("z"))
    fitted = scored.select("n", "below", F.expr(normal_cdf("z")).alias("p"),
                           total.alias("rows"))
    rows = F.col("rows")
    return fitted.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
        F.max(F.greatest((F.col("below") + F.col("n")) / rows - F.col("p"),
                         F.col("p") - F.col("below") / rows)).alias("statistic"))
