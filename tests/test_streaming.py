"""Arriving files are read once, routed by name and written idempotently."""

import gzip
import os

import pytest
from pyspark.sql import functions as F

from cinestrata.plans.layers import RunConfig, run_table
from cinestrata.schema import TABLES
from cinestrata.sources import readers
from cinestrata.streaming import incremental

HEADER = "tconst\taverageRating\tnumVotes\n"


def arrive(root, day, ids, name="title.ratings.tsv.gz", header=HEADER):
    path = f"{root}/raw/titles/day{day:03d}/{name}"
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with gzip.open(path, "wt") as f:
        f.write(header + "".join(f"tt{i}\t{1 + i % 9}.0\t{i}\n" for i in ids))


def test_each_file_once(spark, root):
    def ingest():
        return incremental.ingest_incremental(
            spark, f"{root}/raw", "ratings", f"{root}/out", f"{root}/ckpt")

    arrive(root, 1, range(10, 20))
    ingest()
    assert ingest() == 0
    arrive(root, 2, range(20, 25))
    ingest()
    assert spark.read.parquet(f"{root}/out").count() == 15


def test_file_names(spark):
    key = "titles/day028/title.ratings.tsv.gz"
    df = spark.createDataFrame([(key,), ("x/name.basics.tsv.gz",), ("x/readme.txt",)], "p string")
    got = [r[0] for r in df.select(incremental.file_type(F.col("p"))).collect()]
    assert got == ["ratings", "names", None]


def test_batches_of_one_date_add_up_and_reruns_replace(spark, root):
    cfg = RunConfig(root, "2025-09-28 12:00:00", 2024)

    def run(checkpoint):
        incremental.incremental_medallion(
            spark, f"{root}/raw", "ratings", cfg, f"{root}/{checkpoint}", files_per_batch=1)

    arrive(root, 1, range(10, 20))
    arrive(root, 1, range(3), name="title.crew.tsv.gz")
    run("ckpt")
    arrive(root, 2, range(20, 30))
    run("ckpt")
    refined = readers.read_layer(spark, f"{root}/refined/ratings")
    assert refined.count() == 20 == refined.select("tconst").distinct().count()
    popular = {r["numVotes"] for r in refined.where("is_popular = 1").collect()}
    assert popular == set(range(26, 30))


def test_batch_runs_and_streams_share_a_layer(spark, root):
    cfg = RunConfig(root, "2025-09-28 12:00:00", 2024, database="layers_db_" + root[-8:])
    arrive(root, 1, range(10, 60))
    raw = f"{root}/raw/titles/day001/title.ratings.tsv.gz"
    assert run_table(spark, "ratings", cfg, raw) and not run_table(spark, "ratings", cfg, raw)
    for day in (2, 3, 4):
        arrive(root, day, range(day * 100, day * 100 + 30))
        incremental.incremental_medallion(
            spark, f"{root}/raw", "ratings", cfg, f"{root}/ckpt", layout="titles/day00[234]/*.tsv.gz")
    refined = readers.read_layer(spark, f"{root}/refined/ratings")
    votes = sorted(r["numVotes"] for r in refined.collect())
    assert votes == [*range(10, 60), *(d * 100 + i for d in (2, 3, 4) for i in range(30))]
    cut = refined.selectExpr("percentile(numVotes, 0.8)").first()[0]
    assert {r["numVotes"] for r in refined.where("is_popular = 1").collect()} == {
        v for v in votes if v >= cut}
    for layer in ("trusted", "refined"):
        assert spark.table(f"{cfg.database}.ratings_{layer}").count() == 140
    assert spark.table(f"{cfg.database}.ratings_refined").select("is_popular").distinct().count() == 2


def test_a_failed_batch_keeps_its_date_and_leaves_nothing_twice(spark, root, monkeypatch):
    def run(day):
        cfg = RunConfig(root, f"2025-09-{day} 12:00:00", 2024)
        incremental.incremental_medallion(spark, f"{root}/raw", "ratings", cfg, f"{root}/ckpt")

    arrive(root, 1, range(10, 110))
    real = incremental.refine_date

    def failing(*args):
        raise OSError("no space")

    monkeypatch.setattr(incremental, "refine_date", failing)
    with pytest.raises(OSError):
        run(28)
    monkeypatch.setattr(incremental, "refine_date", real)
    write, calls = incremental.write_layer, []

    def once(*args, **kwargs):
        write(*args, **kwargs)
        if not calls:
            calls.append(1)
            raise OSError("lost")

    arrive(root, 2, range(200, 210))
    monkeypatch.setattr(incremental, "write_layer", once)
    with pytest.raises(Exception):
        run(29)
    run(30)
    for layer in ("trusted", "refined"):
        rows = readers.read_layer(spark, f"{root}/{layer}/ratings")
        days = {r["ingestion_day"]: r["count"] for r in rows.groupBy("ingestion_day").count().collect()}
        assert days == {28: 100, 29: 10}


def test_rows_of_many_batches_are_all_counted(spark, root):
    for day in range(104):
        arrive(root, day, range(10 + day, 12 + day))
    arrive(root, 200, range(3), name="title.crew.tsv.gz")
    read = incremental.ingest_incremental(spark, f"{root}/raw", "ratings", f"{root}/out", f"{root}/ckpt",
                                          files_per_batch=1, layout="titles/*/title.ratings.tsv.gz")
    assert read == 208 == spark.read.parquet(f"{root}/out").count()


def test_a_swapped_header_is_an_error(spark, root):
    arrive(root, 1, range(10, 12), header="tconst\tnumVotes\taverageRating\n")
    path = f"{root}/raw/titles/day001/title.ratings.tsv.gz"
    with pytest.raises(Exception, match="header"):
        readers.read_raw_tsv(spark, path, TABLES["ratings"].raw_schema).collect()
