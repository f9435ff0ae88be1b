"""Run metadata and partitioned parquet layers."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from cinestrata.schema import BATCH_COLUMN, PARTITION_COLUMNS


def add_ingestion_metadata(df: DataFrame, run_ts: str, with_date: bool = False) -> DataFrame:
    """Add the run's timestamp and its year, month and day: constants, so no extra work."""
    ts = F.lit(run_ts).cast("timestamp")
    out = df.select(
        "*", ts.alias("ingestion_timestamp"), F.year(ts).alias("ingestion_year"),
        F.month(ts).alias("ingestion_month"), F.dayofmonth(ts).alias("ingestion_day"))
    return out.select("*", F.to_date(ts).alias("ingestion_date")) if with_date else out


def balanced(df: DataFrame) -> DataFrame:
    """Let AQE cut the rows into partitions of even size, however few files they came from.

    Rows are dealt by a hash of what they hold. Dealt in turns, a task would first sort all its
    rows (so that a repeated task deals them alike), and spill those of a large file.
    """
    keys = [F.col(f"`{f.name}`") for f in df.schema if isinstance(f.dataType, T.AtomicType)]
    return df.hint("rebalance", *keys)


def write_layer(df: DataFrame, path: str, layout: str = "ingestion",
                batch: str | None = None) -> None:
    """Write a layer partitioned by run date, replacing only the dates it holds.

    With ``batch``, or a column of that name, rows go below their date to a partition of the
    batch, and only those partitions are replaced.

    ``layout='ymd'`` uses zero-padded ``year=/month=/day=`` folders instead of the
    ingestion columns. The write itself shuffles nothing: rows from an unsplittable
    compressed file should pass :func:`balanced` before their metadata is added.
    """
    keys = list(PARTITION_COLUMNS)
    if batch is not None:
        df = df.withColumn(BATCH_COLUMN, F.lit(batch))
    if BATCH_COLUMN in df.columns:
        keys.append(BATCH_COLUMN)
    if layout == "ymd":
        names = ("year", "month", "day")
        widths = (4, 2, 2)
        padded = [F.lpad(F.col(k).cast("string"), w, "0").alias(n)
                  for k, n, w in zip(keys, names, widths)]
        df = df.select(*[c for c in df.columns if c not in keys], *padded)
        keys = list(names)
    elif layout != "ingestion":
        raise ValueError(f"unknown layout {layout!r}")
    (df.write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path))


def write_bucketed(df: DataFrame, full_name: str, path: str, key: str, buckets: int) -> None:
    """Write a catalog table bucketed and sorted by key: joins of such tables do not shuffle.

    Rows are first brought together by bucket, so a bucket is one file, not one per task.
    """
    (df.repartition(buckets, key).write.mode("overwrite").format("parquet")
     .option("path", path).bucketBy(buckets, key).sortBy(key).saveAsTable(full_name))


def write_lookup(df: DataFrame, path: str, key: str, rows_per_file: int = 4_000_000) -> None:
    """Write a table for lookups by id, with a Bloom filter of the ids per row group.

    A lookup's ids are tried against the filters, so row groups without them are not read,
    wherever an id lies. The column is kept out of dictionaries, which would replace the filter.
    A filter takes a byte and a half per id at one wrong hit in a hundred.
    """
    (df.write.option(f"parquet.bloom.filter.enabled#{key}", "true")
     .option(f"parquet.bloom.filter.adaptive.enabled#{key}", "true")
     .option(f"parquet.enable.dictionary#{key}", "false")
     .option("maxRecordsPerFile", rows_per_file).parquet(path))
