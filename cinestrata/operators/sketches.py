"""Quantile sketches: one per batch, kept as rows and merged, so old batches are not read again."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Values a sketch keeps at its lowest level; the error falls in proportion.
SIZE = 1024


def rank_error(size: int = SIZE) -> float:
    """Normalised rank error that a sketch of the size keeps to in 99 of 100 cases.

    The constants are those published for this sketch.
    """
    return 2.296 / size ** 0.9723


def sketched(df: DataFrame, column: str | Column, by: Sequence[str] = (),
             size: int = SIZE) -> DataFrame:
    """``by, n, sketch``: a KLL sketch of the column's numbers per group, combined on the map side."""
    source = F.col(column) if isinstance(column, str) else column
    values = df.select(*by, source.cast("double").alias("value")).where(
        F.col("value").isNotNull() & ~F.isnan("value"))
    return values.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double("value", F.lit(size)).alias("sketch"))


def merged(sketches: DataFrame, by: Sequence[str] = (), size: int = SIZE) -> DataFrame:
    """``by, n, sketch`` of the groups' sketches together; the values are not read."""
    return sketches.groupBy(*by).agg(
        F.sum("n").alias("n"), F.kll_merge_agg_double("sketch", F.lit(size)).alias("sketch"))


def quantiles(sketches: DataFrame, probabilities: Sequence[float]) -> DataFrame:
    """The sketches' rows, one per probability, with ``prob`` and the estimated ``value``."""
    found = F.array(*[F.struct(
        F.lit(float(p)).alias("prob"),
        F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))).alias("value"))
        for p in probabilities])
    kept = [c for c in sketches.columns if c != "sketch"]
    return sketches.where("n > 0").select(*kept, F.inline(found))


class SketchStore:
    """Sketches of a column by batch, below a path; a batch that is written again replaces itself."""

    def __init__(self, spark: SparkSession, path: str, column: str, size: int = SIZE):
        self.spark, self.path, self.column, self.size = spark, path, column, size

    def add(self, batch: DataFrame, label: str) -> None:
        """Read one batch, once; no other batch is touched."""
        one = sketched(batch, self.column, size=self.size).withColumn("batch", F.lit(label))
        (one.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch").parquet(self.path))

    def batches(self) -> DataFrame:
        """``n, sketch, batch``, a row per batch."""
        try:
            return self.spark.read.schema("n long, sketch binary, batch string").parquet(self.path)
        except AnalysisException as err:
            if err.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], "n long, sketch binary, batch string")

    def quantile(self, probability: float) -> float | None:
        """The estimate over all batches so far."""
        found = quantiles(merged(self.batches(), size=self.size), [probability]).first()
        return None if found is None else found["value"]
