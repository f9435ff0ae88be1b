import os
import time
from concurrent.futures import ThreadPoolExecutor
from threading import Barrier

import pytest
from pyspark.sql import functions as F

from cinestrata.operators.lookup import lookup
from cinestrata.plans import layers
from cinestrata.plans.layers import RunConfig, run_table
from cinestrata.sources import claims, footers
from cinestrata.sources.readers import read_layer, write_raw_tsv
from cinestrata.sources.sinks import write_lookup


def leaves(df):
    plan = df._jdf.queryExecution().executedPlan()
    if "Adaptive" in plan.nodeName():
        plan = plan.executedPlan()
    found = plan.collectLeaves()
    return [found.apply(i) for i in range(found.size())]


def test_lookup_skips_row_groups(spark, root):
    ids = spark.range(300_000).select(F.md5(F.col("id").cast("string")).alias("id"),
                                   F.col("id").alias("v")).repartition(6, "v")
    write_lookup(ids, f"{root}/bloom", "id", rows_per_file=10_000)
    ids.write.parquet(f"{root}/plain")
    wanted = [r["id"] for r in ids.where("v in (7, 77777)").collect()] + ["0" * 32]
    read = {}
    for kind in ("bloom", "plain"):
        df = lookup(spark.read.parquet(f"{root}/{kind}"), wanted, "id")
        assert sorted(r["v"] for r in df.collect()) == [7, 77777]
        read[kind] = sum(s.metrics().apply("numOutputRows").value() for s in leaves(df))
    assert read["plain"] == 300_000 and read["bloom"] <= 100_000
    assert lookup(spark.read.parquet(f"{root}/bloom"), ["1" * 32], "id").collect() == []


def test_profile_from_footers_reads_no_column(spark, root):
    df = spark.range(1000).select(
        F.when(F.col("id") % 10 != 0, F.col("id")).alias("a"), (F.col("id") * -0.5).alias("b-c"),
        F.lit(None).cast("int").alias("none"), F.lit("x").alias("s"), (F.col("id") % 3).alias("part"))
    df.write.partitionBy("part").parquet(root)
    got = {r["column"]: tuple(r)[1:] for r in footers.footer_profile(
        spark, root, ["a", "b-c", "none"]).collect()}
    assert got == {"a": (1000, 900, 1.0, 999.0), "b-c": (1000, 1000, -499.5, 0.0),
                   "none": (1000, 0, None, None)}
    wanted = [F.count(F.lit(1)), F.min("a"), F.max("a")]
    plan = footers.footer_aggregate(spark, root, wanted)._jdf.queryExecution().executedPlan().toString()
    assert "max(a)" in plan and "PushedAggregation: [COUNT(*), MIN(a), MAX(a)]" in plan
    assert footers.rows_by_partition(spark, root, ["part"]) == {(0,): 334, (1,): 333, (2,): 333}
    with pytest.raises(ValueError, match="column s"):
        footers.footer_profile(spark, root, ["s"])
    assert spark.conf.get("spark.sql.sources.useV1SourceList") != ""


def test_profile_with_nan_is_scanned(spark, root):
    spark.createDataFrame([(1.0,), (float("nan"),), (None,)], "v double").coalesce(1).write.parquet(root)
    row = footers.footer_profile(spark, root).first()
    assert (row["rows"], row["filled"], row["min"]) == (3, 2, 1.0)


def test_one_of_many_gets_the_claim(spark, root):
    start, held = Barrier(6), []

    def want(i):
        start.wait()
        with claims.claimed(spark, f"{root}/work", 60) as claim:
            held.append(claim is not None)
            time.sleep(0.5)

    with ThreadPoolExecutor(6) as pool:
        list(pool.map(want, range(6)))
    assert sum(held) == 1
    with claims.claimed(spark, f"{root}/work", 60) as again:
        assert again is not None


def test_abandoned_claim_is_taken_over(spark, root):
    folder = claims._Folder(spark, f"{root}/work")
    assert folder.create(0) and not folder.create(0)
    with claims.claimed(spark, f"{root}/work", 60) as claim:
        assert claim is None
    old = time.time() - 120
    os.utime(f"{root}/work/claim-000000", (old, old))
    with claims.claimed(spark, f"{root}/work", 60) as claim:
        assert claim.number == 1
        with pytest.raises(claims.LostClaim):
            claims.Claim(folder, 0).check()
        claim.check()
    assert folder.latest() is None


def _raw(spark, root):
    rows = spark.createDataFrame([(f"tt{i}", 6.0, 10 * i) for i in range(1, 30)],
                                 "tconst string, averageRating double, numVotes int")
    write_raw_tsv(rows, f"{root}/raw/title.ratings.tsv.gz")
    return f"{root}/raw/title.ratings.tsv.gz"


def test_concurrent_runs_of_a_date_write_once(spark, root):
    raw, cfg = _raw(spark, root), RunConfig(root, "2025-09-28 12:00:00", 2024)
    with ThreadPoolExecutor(3) as pool:
        runs = [pool.submit(run_table, spark, "ratings", cfg, raw) for _ in range(3)]
        assert sorted(r.result() for r in runs) == [False, False, True]
    assert read_layer(spark, cfg.path("refined", "ratings")).count() == 29


def test_run_killed_half_way_is_repeated(spark, root, monkeypatch):
    raw, cfg = _raw(spark, root), RunConfig(root, "2025-09-28 12:00:00", 2024, stale_seconds=30)

    def die(*args):
        raise KeyboardInterrupt

    monkeypatch.setattr(layers, "refine_date", die)
    with pytest.raises(KeyboardInterrupt):
        run_table(spark, "ratings", cfg, raw)
    monkeypatch.undo()
    # A run that could not even drop its claim.
    folder = claims._Folder(spark, f"{root}/_claims/ratings/2025-09-28")
    folder.create(4)
    assert run_table(spark, "ratings", cfg, raw) is False
    old = time.time() - 60
    os.utime(f"{root}/_claims/ratings/2025-09-28/claim-000004", (old, old))
    assert run_table(spark, "ratings", cfg, raw) is True
    assert read_layer(spark, cfg.path("refined", "ratings")).count() == 29


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_layer_writes_sort_no_rows(spark, root, monkeypatch):
    cfg = RunConfig(root, "2025-09-28 12:00:00", 2024)
    written = {}
    write = layers.write_layer

    def noted(df, path, **options):
        written[path] = df
        write(df, path, **options)

    monkeypatch.setattr(layers, "write_layer", noted)
    assert run_table(spark, "ratings", cfg, _raw(spark, root)) is True
    # Dealt by hash: in turns, Spark sorts a task's rows before it deals them.
    assert "hashpartitioning" in _plan(written[cfg.path("trusted", "ratings")])
    # Partition columns are constants: the write needs no sort by them.
    optimised = written[cfg.path("refined", "ratings")]._jdf.queryExecution().optimizedPlan()
    text = optimised.toString()
    for value, name in ((2025, "year"), (9, "month"), (28, "day"), ("run", "batch")):
        assert f"{value} AS ingestion_{name}" in text
    refined = spark.read.parquet(cfg.path("refined", "ratings"))
    parts = refined.select("ingestion_year", "ingestion_month", "ingestion_day", "ingestion_batch")
    assert [tuple(r) for r in parts.distinct().collect()] == [(2025, 9, 28, "run")]
    assert refined.count() == spark.read.parquet(cfg.path("trusted", "ratings")).count()
