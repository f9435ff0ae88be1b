"""Raw rows that cannot be read as their table: kept aside with file, line and reason.

Reading text leniently turns broken cells into NULL and nobody learns of it. Here each line
is read as text, split, and tried against the table's columns, types and keys; what fails is
written to a reject table, in batch runs and in streams, so that good and rejected rows add
up to the rows read.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from cinestrata.operators.cleaning import CLEANERS
from cinestrata.schema import BATCH_COLUMN, NULL_TOKEN, TableSpec, table
from cinestrata.session import materialised

REJECTS = "file string, line long, reason string, text string"
_PLACE = ("file", "block", "at")


def _lines(lines: DataFrame) -> DataFrame:
    """``file, block, at`` (where a line was read), ``text`` and its ``cells``, of a text source."""
    return lines.select(F.col("_metadata.file_path").alias("file"),
                        F.col("_metadata.file_block_start").alias("block"),
                        F.monotonically_increasing_id().alias("at"), F.col("value").alias("text"),
                        F.split("value", "\t", -1).alias("cells"))


def _reason(spec: TableSpec, cells: Column) -> Column:
    """Why a line is no row of the table; NULL if it is one. The first reason counts."""
    n = len(spec.columns)
    reason = F.when(F.size(cells) != n, F.concat(
        F.lit("cells: "), F.size(cells).cast("string"), F.lit(f" of {n}")))
    place = {c: i for i, c in enumerate(spec.columns)}

    def value(column: str) -> Column:
        return F.nullif(F.get(cells, F.lit(place[column])), F.lit(NULL_TOKEN))

    for key in spec.keys:
        reason = reason.when(F.coalesce(F.trim(value(key)), F.lit("")) == "",
                             F.lit(f"no key: {key}"))
    for column, kind in spec.types.items():
        broken = value(column).isNotNull() & value(column).try_cast(kind).isNull()
        reason = reason.when(broken, F.lit(f"not {kind}: {column}"))
    return reason


def checked(every: DataFrame, name: str) -> DataFrame:
    """The lines that are rows, with the ``reason`` why not: no header, no blank lines."""
    spec = table(name)
    header = "\t".join(spec.columns)
    return every.where((F.col("text") != "") & (F.col("text") != header)).withColumn(
        "reason", _reason(spec, F.col("cells")))


def good_rows(found: DataFrame, name: str) -> DataFrame:
    """The readable rows as the raw reader gives them: text columns, the sentinel as NULL."""
    spec = table(name)
    return found.where("reason is null").select(*[
        F.nullif(F.get("cells", F.lit(i)), F.lit(NULL_TOKEN)).alias(c)
        for i, c in enumerate(spec.columns)])


def rejected(found: DataFrame, every: DataFrame) -> DataFrame:
    """``file, line, reason, text`` of the rows with a reason, lines counted from 1.

    ``every`` has ``file, block, at`` of all lines, headers and blank ones included. A block is
    read in order by one task, so a line is its distance from the block's first line behind the
    lines of the file's earlier blocks. Blocks are counted; only rejected rows are joined.
    """
    blocks = every.groupBy("file", "block").agg(F.min("at").alias("first"),
                                                F.count(F.lit(1)).alias("n"))
    # A file has as many blocks as tasks that read it.
    before = Window.partitionBy("file").orderBy("block").rowsBetween(
        Window.unboundedPreceding, -1)
    starts = blocks.select("file", "block", "first",
                           F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
    return found.where("reason is not null").join(starts, ["file", "block"]).select(
        "file", (F.col("earlier") + F.col("at") - F.col("first") + 1).alias("line"),
        "reason", "text")


def counts(found: DataFrame) -> DataFrame:
    """``file, read, good, rejected`` of each file."""
    return found.groupBy("file").agg(
        F.count(F.lit(1)).alias("read"), F.count_if(F.col("reason").isNull()).alias("good"),
        F.count_if(F.col("reason").isNotNull()).alias("rejected"))


def headers_missing(every: DataFrame, name: str) -> DataFrame:
    """``file`` of the files without the table's header line."""
    header = "\t".join(table(name).columns)
    return (every.groupBy("file").agg(F.count_if(F.col("text") == header).alias("headers"))
            .where("headers = 0").select("file"))


def _write(df: DataFrame, path: str, label: str) -> None:
    """Replace the label's partition and no other: a repeated batch leaves no double rows."""
    (df.withColumn(BATCH_COLUMN, F.lit(label)).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(BATCH_COLUMN).parquet(path))


def accepted(lines: DataFrame, name: str, rejects: str, log: str, label: str) -> DataFrame:
    """The good raw rows of one batch of lines; its rejects and counts by file are written.

    The text is split once and written; rows, rejects and counts are read from there.
    """
    every = materialised(_lines(lines), "lines")
    missing = headers_missing(every, name).limit(5).collect()
    if missing:
        raise ValueError(f"no header of {name} in {', '.join(r['file'] for r in missing)}")
    found = checked(every, name)
    _write(rejected(found, every.select(*_PLACE)), rejects, label)
    _write(counts(found), log, label)
    return good_rows(found, name)


def _store(lines: DataFrame, name: str, root: str, label: str) -> None:
    """One batch of lines: rejects, counts by file and the cleaned good rows, under its label."""
    good = accepted(lines, name, f"{root}/rejects", f"{root}/counts", label)
    _write(CLEANERS[name](good), f"{root}/rows", label)


def ingest_checked(spark: SparkSession, raw: str, name: str, root: str,
                   label: str = "run") -> None:
    """Files below ``raw`` to ``rows``, ``rejects`` and ``counts`` of ``root``, as one batch."""
    lines = spark.read.option("recursiveFileLookup", True).text(raw)
    _store(lines, name, root, label)


def ingest_checked_stream(spark: SparkSession, raw: str, name: str, root: str,
                          files_per_batch: int | None = None) -> None:
    """New files below ``raw`` to the same tables, a partition per batch; each file once.

    A batch that fails half-way is repeated under its number and replaces what it had written.
    """
    reader = spark.readStream.option("recursiveFileLookup", True)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    stream = reader.text(raw).select("value", "_metadata")

    def run(batch: DataFrame, number: int) -> None:
        _store(batch, name, root, f"stream-{number}")

    (stream.writeStream.foreachBatch(run).option("checkpointLocation", f"{root}/checkpoint")
     .trigger(availableNow=True).start().awaitTermination())


def read_rejects(spark: SparkSession, root: str) -> DataFrame:
    """All rejected rows so far; none before the first run."""
    try:
        return spark.read.schema(f"{REJECTS}, {BATCH_COLUMN} string").parquet(f"{root}/rejects")
    except AnalysisException as err:
        if err.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], f"{REJECTS}, {BATCH_COLUMN} string")
