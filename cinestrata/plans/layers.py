"""RAW to TRUSTED to REFINED for one table and one run date."""

from __future__ import annotations

import json
from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from cinestrata.functions import tables
from cinestrata.functions.lists import items
from cinestrata.functions.tables import with_features
from cinestrata.operators.aggregates import top_names
from cinestrata.operators.cleaning import CLEANERS, clean_generic
from cinestrata.operators.quantiles import exact_quantiles, quantile
from cinestrata.plans.counts import ValueCounts, most_frequent
from cinestrata.schema import (
    BATCH_COLUMN, BATCH_RUN, NULL_TOKEN, PARTITION_COLUMNS, table)
from cinestrata.sources.claims import claimed
from cinestrata.sources.catalog import add_columns, add_partitions, register_table
from cinestrata.sources.quarantine import accepted
from cinestrata.sources.readers import read_layer, read_raw_tsv
from cinestrata.sources.sinks import add_ingestion_metadata, balanced, write_layer

# Genres that get a flag in the extended titles.
TOP_GENRES = 10


@dataclass(frozen=True)
class RunConfig:
    """Where the layers are and what is constant within a run."""

    root: str
    run_ts: str
    as_of_year: int
    database: str | None = None
    popular_share: float = 0.8
    vote_threshold: float | None = None  # a known threshold spares the quantile's scan
    rebalance: bool = True  # one shuffle, for RAW in few unsplittable files
    feature_variant: str = "standard"  # or "extended": the second variant of the features
    keep_rejects: bool = False  # rows that cannot be read go to ``rejects``, and counts to ``read``
    stale_seconds: float = 600.0  # a run that shows no sign of life for so long may be repeated

    def __post_init__(self) -> None:
        if self.feature_variant not in ("standard", "extended"):
            raise ValueError(f"unknown feature variant {self.feature_variant!r}")

    def path(self, layer: str, name: str) -> str:
        return f"{self.root}/{layer}/{name}"


def of_run(df: DataFrame, run_ts: str) -> DataFrame:
    """The rows of the run's date: a partition filter."""
    ts = F.lit(run_ts).cast("timestamp")
    year, month, day = (F.col(c) for c in PARTITION_COLUMNS)
    return df.where((year == F.year(ts)) & (month == F.month(ts)) & (day == F.dayofmonth(ts)))


def run_exists(spark: SparkSession, path: str, run_ts: str) -> bool:
    """Whether the layer already holds rows of a batch run of the date."""
    try:
        layer = read_layer(spark, path)
    except AnalysisException as err:
        if err.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return False
        raise
    return bool(of_run(layer, run_ts).where(F.col(BATCH_COLUMN) == BATCH_RUN).head(1))


def refine(trusted: DataFrame, name: str, cfg: RunConfig, threshold: float | None = None,
           genres: Sequence[str] | None = None) -> DataFrame:
    """The table's features in the run's variant.

    Without a threshold or genres given, they are those of the given rows.
    """
    extended = cfg.feature_variant == "extended"
    if name == "ratings":
        if threshold is None:
            threshold = cfg.vote_threshold
        if threshold is None:
            threshold = quantile(trusted, "numVotes", cfg.popular_share)
        return with_features(trusted, tables.ratings(threshold, extended))
    if genres is None:
        genres = top_names(trusted, "genres", TOP_GENRES, as_list=True) \
            if extended and name == "basics" else []
    second = tables.extended(name, cfg.as_of_year, genres) if extended else None
    if second is not None:
        return with_features(trusted, second)
    if name in tables.FEATURES:
        return with_features(trusted, tables.FEATURES[name](cfg.as_of_year))
    plain = [c for c in trusted.columns if not c.startswith("ingestion_")]
    return with_features(trusted, tables.generic(plain))


def run_table(spark: SparkSession, name: str, cfg: RunConfig, raw_path: str,
              force: bool = False) -> bool:
    """Run one table's layers; False when the date was done before and ``force`` is not set.

    RAW is parsed once. REFINED is computed from the TRUSTED files just written, so
    no step repeats the text parsing and a failed step can start from files. Of several runs
    of a date at a time one does the work, and the others return False.
    """
    if not force and run_exists(spark, cfg.path("refined", name), cfg.run_ts):
        return False
    path = f"{cfg.root}/_claims/{name}/{cfg.run_ts[:10]}"
    with claimed(spark, path, cfg.stale_seconds) as claim:
        # The run that held the claim until now may have done it.
        if claim is None or not force and run_exists(
                spark, cfg.path("refined", name), cfg.run_ts):
            return False
        if cfg.keep_rejects:
            lines = spark.read.text(raw_path)
            raw = accepted(lines, name, cfg.path("rejects", name), cfg.path("read", name),
                           f"{cfg.run_ts[:10]}-{BATCH_RUN}")
        else:
            raw = read_raw_tsv(spark, raw_path, table(name).raw_schema, null_token=NULL_TOKEN)
        clean = CLEANERS.get(name, clean_generic)(raw)
        rows = balanced(clean) if cfg.rebalance else clean
        write_layer(add_ingestion_metadata(rows, cfg.run_ts), cfg.path("trusted", name),
                    batch=BATCH_RUN)
        claim.check()
        refine_date(spark, name, cfg, cfg.run_ts, [BATCH_RUN])
        return True


def refine_date(spark: SparkSession, name: str, cfg: RunConfig, run_ts: str,
                batches: Sequence[str]) -> None:
    """REFINED of the named batches of a run date, from the TRUSTED files, and the catalog tables.

    The popularity of ratings and the genres of the extended titles depend on all rows of the
    date. They are derived from value counts kept per batch, so of other batches only those are
    refined anew in which a flag changes: the result is that of one run over the same rows, in
    whatever order they came. Other features are per row.
    """
    trusted_path, refined_path = cfg.path("trusted", name), cfg.path("refined", name)
    try:
        trusted = of_run(read_layer(spark, trusted_path), run_ts)
    except AnalysisException as err:
        if err.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return    # no batch had a clean row
        raise
    state = _state_of(spark, name, cfg, run_ts)
    if state is None:
        trusted = _of_batches(trusted, run_ts, batches)
        refined = refine(trusted, name, cfg)
    else:
        now, affected = state.updated(trusted, batches)
        trusted = _of_batches(trusted, run_ts, {*batches, *affected})
        refined = refine(trusted, name, cfg, **now)
    write_layer(refined, refined_path)
    if state is not None:
        state.note(now)
    if cfg.database:
        keys = (*PARTITION_COLUMNS, BATCH_COLUMN)
        written = [tuple(r) for r in trusted.select(*keys).distinct().collect()]
        for layer, df, path in (("trusted", trusted, trusted_path),
                                ("refined", refined, refined_path)):
            full = register_table(spark, cfg.database, f"{name}_{layer}", df.schema, path, keys)
            add_columns(spark, full, df.schema)
            add_partitions(spark, full, keys, written)


def _of_batches(trusted: DataFrame, run_ts: str, batches: Iterable[str]) -> DataFrame:
    """The batches' rows of the run date, with what names their partitions as constants.

    A write sorts its rows by partition columns that come from files, and so holds or spills a
    task's rows; constants need no sort. Several batches are still sorted by batch.
    """
    names = sorted({*batches})
    ts = F.lit(run_ts).cast("timestamp")
    known = dict(zip(PARTITION_COLUMNS, (F.year(ts), F.month(ts), F.dayofmonth(ts))))
    if len(names) == 1:
        known[BATCH_COLUMN] = F.lit(names[0])
    types = {c: trusted.schema[c].dataType for c in known}
    return trusted.where(F.col(BATCH_COLUMN).isin(*names)).withColumns(
        {c: value.cast(types[c]) for c, value in known.items()})


class _DateState:
    """The value counts of a run date's batches, and what was last derived of them.

    What was derived is noted after REFINED is written. A run that fails before that leaves the
    older note, and the next one refines all batches that differ from it.
    """

    def __init__(self, spark: SparkSession, name: str, cfg: RunConfig, run_ts: str):
        self.spark, self.name, self.cfg = spark, name, cfg
        self.path = f"{cfg.root}/_counts/{name}/{cfg.feature_variant}/{run_ts[:10]}"
        self.counts = ValueCounts(spark, f"{self.path}/values",
                                  "int" if name == "ratings" else "string")

    def updated(self, trusted: DataFrame, batches: Sequence[str]) -> tuple[dict, set[str]]:
        """The setting of the date's features after the batches, and the batches it changes.

        Only the new batches' values are read, and those of batches never counted before.
        """
        present = {r[0] for r in trusted.select(BATCH_COLUMN).distinct().collect()}
        new = {*batches, *(present - self.counts.batches())}
        value = F.col("numVotes") if self.name == "ratings" else F.explode(items("genres"))
        self.counts.add(trusted.where(F.col(BATCH_COLUMN).isin(*sorted(new))), value)
        before = self.noted()
        if self.name == "ratings":
            share = [self.cfg.popular_share]
            found = exact_quantiles(self.counts.total(), "value", share, weight="n").first()
            now = None if found is None else found["value"]    # no votes at all
            if before is None or now is None:
                return {"threshold": now}, present
            return {"threshold": now}, self.counts.holding(*sorted((float(before), now)))
        genres = sorted(most_frequent(self.counts.total(), TOP_GENRES))
        same = before is not None and json.loads(before) == genres
        return {"genres": genres}, set() if same else present

    def noted(self) -> str | None:
        try:
            row = self.spark.read.schema("setting string").parquet(f"{self.path}/setting").first()
        except AnalysisException as err:
            if err.getCondition() != "PATH_NOT_FOUND":
                raise
            return None
        return None if row is None else row["setting"]

    def note(self, now: dict) -> None:
        """One row, replaced; without it the next run refines every batch."""
        (setting,) = now.values()
        if setting is None:
            return
        text = repr(setting) if self.name == "ratings" else json.dumps(setting)
        (self.spark.createDataFrame([(text,)], "setting string").coalesce(1)
         .write.mode("overwrite").parquet(f"{self.path}/setting"))


def _state_of(spark: SparkSession, name: str, cfg: RunConfig, run_ts: str) -> _DateState | None:
    """The state of tables with features across rows; None for the others."""
    by_votes = name == "ratings" and cfg.vote_threshold is None
    by_genres = name == "basics" and cfg.feature_variant == "extended"
    return _DateState(spark, name, cfg, run_ts) if by_votes or by_genres else None


def run_tables(spark: SparkSession, cfg: RunConfig, raw_paths: dict[str, str],
               force: bool = False, at_once: int = 4) -> dict[str, bool]:
    """:func:`run_table` for several independent tables, ``at_once`` of them at a time.

    One table's narrow steps (a single compressed file, a short aggregate) leave task
    slots free that the other tables' jobs use.
    """
    with ThreadPoolExecutor(at_once) as pool:
        runs = {name: pool.submit(run_table, spark, name, cfg, path, force)
                for name, path in raw_paths.items()}
        return {name: run.result() for name, run in runs.items()}
