"""Row and file counts of layers, and column profiles."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

AUDIT_SCHEMA = "table string, layer string, rows bigint, files bigint, ok boolean"


def audit_layers(spark: SparkSession, paths: dict[tuple[str, str], str]) -> DataFrame:
    """One row per (table, layer): rows, files with rows, and whether there are any.

    Files are counted from per-file row counts, so rows never meet in one task.
    """
    parts = []
    for (table, layer), path in paths.items():
        try:
            rows = spark.read.parquet(path)
        except AnalysisException as err:
            if err.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            parts.append(spark.createDataFrame([(table, layer, 0, 0, False)], AUDIT_SCHEMA))
            continue
        per_file = (rows.select(F.col("_metadata.file_path").alias("file"))
                    .groupBy("file").agg(F.count(F.lit(1)).alias("n")))
        total = F.coalesce(F.sum("n"), F.lit(0))
        parts.append(per_file.agg(
            F.lit(table).alias("table"), F.lit(layer).alias("layer"),
            total.alias("rows"), F.count("file").alias("files"), (total > 0).alias("ok")))
    return reduce(DataFrame.unionByName, parts)


def profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row per column: rows, values, minimum, maximum, mean and sum, in one scan."""
    aggregates = [F.count(F.lit(1)).alias("rows")]
    for i, c in enumerate(columns):
        x = F.col(c).cast("double")
        aggregates.append(F.struct(
            F.count(x).alias("filled"), F.min(x).alias("min"), F.max(x).alias("max"),
            F.avg(x).alias("mean"), F.sum(x).alias("sum")).alias(f"c{i}"))
    wide = df.agg(*aggregates)
    entries = F.array(*[
        F.struct(F.lit(c).alias("column"), F.col("rows"),
                 *[F.col(f"c{i}")[k].alias(k) for k in ("filled", "min", "max", "mean", "sum")])
        for i, c in enumerate(columns)])
    return wide.select(F.inline(entries))


def reduction(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows before and after a filter, and the share removed in percent."""
    counts = before.agg(F.count(F.lit(1)).alias("rows_before"))
    kept = after.agg(F.count(F.lit(1))).scalar()
    out = counts.select("rows_before", kept.alias("rows_after"),
                        F.lit(len(after.columns)).alias("columns"))
    return out.select("*", F.try_divide(
        (F.col("rows_before") - F.col("rows_after")) * F.lit(100.0),
        F.col("rows_before").cast("double")).alias("reduction_pct"))


def numeric_columns(df: DataFrame) -> list[str]:
    """Names of the numeric columns, in order."""
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]
