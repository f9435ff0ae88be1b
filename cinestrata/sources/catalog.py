"""Catalog tables over layer folders."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from cinestrata.schema import PARTITION_COLUMNS


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def register_table(spark: SparkSession, database: str, name: str, schema: T.StructType,
                   path: str, partitions: tuple[str, ...] = PARTITION_COLUMNS) -> str:
    """Create an external parquet table over ``path`` unless it exists; give its full name."""
    columns = ", ".join(f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in schema)
    keys = ", ".join(_quoted(p) for p in partitions)
    full = f"{_quoted(database)}.{_quoted(name)}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_quoted(database)}")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {full} ({columns}) USING PARQUET "
        + (f"PARTITIONED BY ({keys}) " if keys else "") + f"LOCATION {_literal(path)}")
    return full


def _literal(value: object) -> str:
    if isinstance(value, int):
        return str(value)
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def add_columns(spark: SparkSession, full_name: str, schema: T.StructType) -> None:
    """Add the columns that files of a later run have and the table lacks."""
    have = {c.lower() for c in spark.table(full_name).columns}
    new = [f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in schema
           if f.name.lower() not in have]
    if new:
        spark.sql(f"ALTER TABLE {full_name} ADD COLUMNS ({', '.join(new)})")


def add_partitions(spark: SparkSession, full_name: str, keys: Sequence[str],
                   values: Iterable[Sequence[object]]) -> None:
    """Make the catalog see the named partitions, without listing the whole folder."""
    parts = ["PARTITION (" + ", ".join(f"{_quoted(k)}={_literal(v)}" for k, v in zip(keys, row))
             + ")" for row in values]
    if parts:
        spark.sql(f"ALTER TABLE {full_name} ADD IF NOT EXISTS {' '.join(parts)}")
        spark.catalog.refreshTable(full_name)


def repair_table(spark: SparkSession, full_name: str) -> DataFrame:
    """Make the catalog see partitions written since the table was registered."""
    spark.sql(f"MSCK REPAIR TABLE {full_name}")
    return spark.table(full_name)
