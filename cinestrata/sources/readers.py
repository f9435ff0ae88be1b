"""Reading the raw dumps, layers and training files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from cinestrata.schema import NULL_TOKEN


def read_raw_tsv(spark: SparkSession, path: str | list[str], schema: T.StructType,
                 null_token: str | None = None) -> DataFrame:
    """Read (compressed) tab-separated files with a header row, no quoting.

    An unbalanced ``"`` is ordinary text here; the reader's default quote would let
    it swallow the next tab. With ``null_token`` the sentinel becomes NULL while
    reading. A header with other names, or in another order, than the schema is an error.
    A compressed file is one task, so writers ask Spark to rebalance.
    """
    reader = (spark.read.schema(schema).option("header", True).option("enforceSchema", False)
              .option("sep", "\t").option("quote", ""))
    if null_token is not None:
        reader = reader.option("nullValue", null_token)
    return reader.csv(path)


def write_raw_tsv(df: DataFrame, path: str, null_token: str = NULL_TOKEN) -> None:
    """Write all columns as text in the raw layout (gzip, tabs, sentinel for NULL)."""
    text = df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])
    (text.write.option("header", True).option("sep", "\t").option("quote", "")
     .option("nullValue", null_token).option("emptyValue", "")
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .option("compression", "gzip").csv(path))


def read_csv(spark: SparkSession, path: str, schema: T.StructType,
             multi_line: bool = True) -> DataFrame:
    """Read a comma-separated training file with a header and declared types.

    A quoted value may hold line breaks, so a file is one task. Without them in the data
    (``multi_line=False``) a large file is split among tasks. The header must name the
    schema's columns in their order.
    """
    return (spark.read.schema(schema).option("header", True).option("enforceSchema", False)
            .option("escape", '"').option("multiLine", multi_line).csv(path))


def read_layer(spark: SparkSession, path: str, merge_schema: bool = False) -> DataFrame:
    """Read a parquet layer; ``merge_schema`` unites the columns of all its files."""
    return spark.read.option("mergeSchema", str(merge_schema).lower()).parquet(path)


def null_sentinel(df: DataFrame, token: str = NULL_TOKEN) -> DataFrame:
    """Replace the sentinel by NULL in every text column, in one projection."""
    return df.select(*[
        F.nullif(F.col(f.name), F.lit(token)).alias(f.name)
        if isinstance(f.dataType, T.StringType) else F.col(f.name)
        for f in df.schema
    ])


def cast_columns(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Cast the named columns; a value that does not fit becomes NULL.

    A column that has its type already is left alone, so filters on it reach the scan.
    """
    have = {f.name: f.dataType.simpleString() for f in df.schema}
    return df.select(*[
        F.col(c).try_cast(types[c]).alias(c) if types.get(c, have[c]) != have[c] else F.col(c)
        for c in df.columns])
