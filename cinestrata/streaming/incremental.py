"""Incremental processing of arriving raw files with Structured Streaming.

The checkpoint remembers which files were read, so a restarted query goes on where
it stopped. ``availableNow`` processes what has arrived and ends.
"""

from __future__ import annotations

from concurrent.futures import Future
from threading import Event

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQueryListener

from cinestrata.operators.cleaning import CLEANERS
from cinestrata.plans.layers import RunConfig, refine_date
from cinestrata.schema import BATCH_COLUMN, NULL_TOKEN, TABLES, table
from cinestrata.sources.quarantine import accepted
from cinestrata.sources.sinks import add_ingestion_metadata, balanced, write_layer

__all__ = ["BATCH_COLUMN", "file_type", "incremental_medallion", "ingest_incremental",
           "read_arrivals"]


def file_type(path: Column) -> Column:
    """The logical table of a file, by the dump's name in its path; NULL if none."""
    names = [F.when(path.contains(spec.file_name), F.lit(spec.name)) for spec in TABLES.values()]
    return F.coalesce(*names)


def read_arriving_lines(spark: SparkSession, raw_dir: str, name: str,
                        files_per_batch: int | None = None,
                        layout: str | None = None) -> DataFrame:
    """A stream of the lines of one table's files, with ``_metadata``; see :func:`read_arrivals`."""
    reader = spark.readStream
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if layout is None:
        reader = reader.option("recursiveFileLookup", True)
    lines = reader.text(raw_dir if layout is None else f"{raw_dir}/{layout}")
    return lines.select("value", "_metadata").where(
        file_type(F.col("_metadata.file_path")) == name)


def read_arrivals(spark: SparkSession, raw_dir: str, name: str,
                  files_per_batch: int | None = None, layout: str | None = None) -> DataFrame:
    """A stream of the raw rows of one table; other tables' files in the folder are left out.

    ``layout`` is a glob of this table's files below ``raw_dir``, such as
    ``*/title.ratings.tsv.gz``. With it other tables' files are neither listed nor counted as
    files of a batch; without it the whole folder is searched. A header that differs from the
    table's columns is an error.
    """
    spec = table(name)
    reader = (spark.readStream.schema(spec.raw_schema).option("header", True)
              .option("enforceSchema", False)
              .option("sep", "\t").option("quote", "").option("nullValue", NULL_TOKEN))
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if layout is None:
        reader = reader.option("recursiveFileLookup", True)
    rows = reader.csv(raw_dir if layout is None else f"{raw_dir}/{layout}")
    return rows.where(file_type(F.col("_metadata.file_path")) == name)


class _RowCounter(StreamingQueryListener):
    """Adds up an observed count over all batches of a run, however many there are."""

    def __init__(self) -> None:
        self.rows: dict[str, int] = {}
        self.ended: dict[str, Event] = {}

    def of(self, run: str) -> Event:
        return self.ended.setdefault(run, Event())

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        seen = event.progress.observedMetrics.get("arrived")
        if seen is not None:
            run = str(event.progress.runId)
            self.rows[run] = self.rows.get(run, 0) + seen["rows"]

    def onQueryTerminated(self, event) -> None:
        self.of(str(event.runId)).set()


def ingest_incremental(spark: SparkSession, raw_dir: str, name: str, out: str,
                       checkpoint: str, files_per_batch: int | None = None,
                       layout: str | None = None) -> int:
    """Append the cleaned rows of new files to ``out``; the number of rows read this time."""
    arrived = read_arrivals(spark, raw_dir, name, files_per_batch, layout).observe(
        "arrived", F.count(F.lit(1)).alias("rows"))
    counter = _RowCounter()
    spark.streams.addListener(counter)
    try:
        query = (CLEANERS[name](arrived).writeStream.format("parquet").option("path", out)
                 .option("checkpointLocation", checkpoint)
                 .outputMode("append").trigger(availableNow=True).start())
        query.awaitTermination()
        run = str(query.runId)
        # Events come in order: after the last one all counts are in.
        if not counter.of(run).wait(300):
            raise TimeoutError("the end of the query was not reported")
        return counter.rows.get(run, 0)
    finally:
        spark.streams.removeListener(counter)


def _records(spark: SparkSession, path: str, schema: str) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as err:
        if err.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def incremental_medallion(spark: SparkSession, raw_dir: str, name: str, cfg: RunConfig,
                          checkpoint: str, files_per_batch: int | None = None,
                          layout: str | None = None) -> None:
    """TRUSTED from new files batch by batch, then REFINED of the dates that got some.

    Layers have the layout of batch runs: below the run date, each batch is a partition named
    by the stream's id and its number. A batch that is tried again, on a later day too, keeps
    the date noted when it was first seen and replaces only itself. A new checkpoint is a new
    stream with names of its own. REFINED follows after the last batch; batches left behind by
    a failure are caught up on by the next call. With ``keep_rejects`` the lines that are no rows
    are kept per batch as well.
    """
    notes = f"{cfg.root}/_batches/{name}"
    stream: Future[str] = Future()

    def noted(label: str) -> str:
        """The run's timestamp of a batch, noted before its first row is written."""
        found = _records(spark, f"{notes}/seen", "label string, run_ts string").where(
            F.col("label") == label).first()
        if found is None:
            (spark.createDataFrame([(label, cfg.run_ts)], "label string, run_ts string")
             .coalesce(1).write.mode("append").parquet(f"{notes}/seen"))
            return cfg.run_ts
        return found["run_ts"]

    def run(batch: DataFrame, batch_id: int) -> None:
        label = f"{stream.result()}-{batch_id}"
        if cfg.keep_rejects:
            batch = accepted(batch, name, cfg.path("rejects", name), cfg.path("read", name), label)
        rows = CLEANERS[name](batch)
        if cfg.rebalance:
            rows = balanced(rows)
        write_layer(add_ingestion_metadata(rows, noted(label)), cfg.path("trusted", name),
                    batch=label)

    read = read_arriving_lines if cfg.keep_rejects else read_arrivals
    query = (read(spark, raw_dir, name, files_per_batch, layout).writeStream
             .foreachBatch(run).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    stream.set_result(str(query.id))
    query.awaitTermination()

    seen = _records(spark, f"{notes}/seen", "label string, run_ts string")
    done = _records(spark, f"{notes}/done", "label string")
    open_: dict[str, list[str]] = {}
    for r in seen.join(done, "label", "left_anti").distinct().orderBy("label").collect():
        open_.setdefault(r["run_ts"], []).append(r["label"])
    for run_ts, labels in sorted(open_.items()):
        refine_date(spark, name, cfg, run_ts, labels)
        (spark.createDataFrame([(x,) for x in labels], "label string").coalesce(1)
         .write.mode("append").parquet(f"{notes}/done"))
