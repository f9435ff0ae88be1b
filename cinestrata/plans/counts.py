"""Value counts per batch: what features across rows need to know of earlier batches.

The popularity threshold is a quantile of all votes of a date, and the genre flags are of its
most frequent genres. Both follow from counts of values, which add up over batches; so a late
batch reads the counts of the others and not their rows.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cinestrata.schema import BATCH_COLUMN


class ValueCounts:
    """Counts of a column's values by batch, below a path; a repeated batch replaces its own."""

    def __init__(self, spark: SparkSession, path: str, kind: str):
        self.spark, self.path, self.schema = spark, path, f"value {kind}, n long"

    def add(self, rows: DataFrame, value: Column) -> None:
        """Count the values of the batches that ``rows`` holds; missing ones are left out."""
        counted = (rows.select(BATCH_COLUMN, value.alias("value")).where("value is not null")
                   .groupBy(BATCH_COLUMN, "value").agg(F.count(F.lit(1)).alias("n")))
        (counted.select("value", "n", BATCH_COLUMN).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy(BATCH_COLUMN)
         .parquet(self.path))

    def by_batch(self) -> DataFrame:
        """``value, n`` and the batch."""
        schema = f"{self.schema}, {BATCH_COLUMN} string"
        try:
            return self.spark.read.schema(schema).parquet(self.path)
        except AnalysisException as err:
            if err.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def batches(self) -> set[str]:
        """The batches counted so far; a run date has few."""
        return {r[0] for r in self.by_batch().select(BATCH_COLUMN).distinct().collect()}

    def total(self) -> DataFrame:
        """``value, n`` over all batches."""
        return self.by_batch().groupBy("value").agg(F.sum("n").alias("n"))

    def holding(self, low: float, high: float) -> set[str]:
        """Batches with a value from ``low`` to below ``high``."""
        inside = (F.col("value") >= low) & (F.col("value") < high)
        return {r[0] for r in self.by_batch().where(inside).select(
            BATCH_COLUMN).distinct().collect()}


def most_frequent(counts: DataFrame, k: int) -> list[str]:
    """The k most frequent values, the first by name on a tie."""
    return [r["value"] for r in counts.orderBy(F.desc("n"), "value").limit(k).collect()]

