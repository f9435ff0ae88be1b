"""Counts and ranges from parquet footers: no column is read."""

from __future__ import annotations

from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from cinestrata.sources.audit import profile

PROFILE = "column string, rows long, filled long, min double, max double"
_IN_FOOTERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType)


def _footer_session(spark: SparkSession) -> SparkSession:
    """A session of the same application whose parquet scans answer aggregates from footers.

    Settings of its own leave those of the caller's session alone.
    """
    session = spark.newSession()
    for name, value in (("spark.sql.sources.useV1SourceList", ""),
                        ("spark.sql.parquet.aggregatePushdown", "true")):
        session.conf.set(name, value)
    return session


def footer_aggregate(spark: SparkSession, path: str, aggregates: Sequence[Column],
                     by: Sequence[str] = ()) -> DataFrame:
    """Counts, minima and maxima of numeric columns, by partition columns if named.

    The result belongs to a session of its own and is to be collected: it has a row per
    partition at most.
    """
    return _footer_session(spark).read.parquet(path).groupBy(*by).agg(*aggregates)


def footer_profile(spark: SparkSession, path: str,
                   columns: Sequence[str] | None = None) -> DataFrame:
    """``column, rows, filled, min, max`` of numeric columns, one row each.

    Footers hold no range of a column with NaN; such columns, if any, are scanned. Columns of
    other types than integers and floats are errors.
    """
    schema = spark.read.parquet(path).schema
    names = list(columns) if columns is not None else [
        f.name for f in schema if isinstance(f.dataType, _IN_FOOTERS)]
    for n in names:
        if not isinstance(schema[n].dataType, _IN_FOOTERS):
            raise ValueError(f"column {n} of type {schema[n].dataType.simpleString()} has no range")
    if not names:
        return spark.createDataFrame([], PROFILE)
    wanted = [F.count(F.lit(1)).alias("rows")]
    for i, n in enumerate(names):
        c = F.col(f"`{n}`")
        wanted += [F.count(c).alias(f"n{i}"), F.min(c).alias(f"lo{i}"), F.max(c).alias(f"hi{i}")]
    try:
        row = footer_aggregate(spark, path, wanted).first()
    except (PySparkException, Py4JJavaError) as err:
        if "aggregatePushdown" not in str(err):
            raise
        return profile(spark.read.parquet(path), names).select("column", "rows", "filled", "min", "max")

    def number(value) -> float | None:
        return None if value is None else float(value)

    return spark.createDataFrame(
        [(n, row["rows"], row[f"n{i}"], number(row[f"lo{i}"]), number(row[f"hi{i}"]))
         for i, n in enumerate(names)], PROFILE)


def rows_by_partition(spark: SparkSession, path: str, keys: Sequence[str]) -> dict[tuple, int]:
    """Rows of each partition of a layer; one entry per partition."""
    found = footer_aggregate(spark, path, [F.count(F.lit(1)).alias("n")], keys).collect()
    return {tuple(r[k] for k in keys): r["n"] for r in found}
