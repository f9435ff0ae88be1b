"""Raw reading, layers, catalog, audit."""

import gzip
import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from cinestrata import session
from cinestrata.operators import cleaning
from cinestrata.plans.layers import RunConfig, run_table
from cinestrata.schema import NULL_TOKEN, PARTITION_COLUMNS, table
from cinestrata.sources import audit, catalog, readers, sinks

RUN = "2025-09-28 12:00:00"
PEOPLE = "tconst string, averageRating double, numVotes int"


def put(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with gzip.open(path, "wt") as f:
        f.write(text)


def test_unbalanced_quote_and_sentinel(spark, root):
    path = f"{root}/title.basics.tsv.gz"
    put(path, "\t".join(table("basics").columns) + "\n"
        'tt1\tmovie\t"Unbalanced\tx\t0\t2000\t\\N\tabc\tDrama\n')
    raw = readers.read_raw_tsv(spark, path, table("basics").raw_schema)
    row = raw.first()
    assert row["primaryTitle"] == '"Unbalanced' and row["endYear"] == NULL_TOKEN
    typed = readers.cast_columns(readers.null_sentinel(raw), table("basics").types).first()
    assert (typed["startYear"], typed["endYear"], typed["runtimeMinutes"]) == (2000, None, None)


def test_typed_columns_keep_pushdown(spark, root):
    spark.createDataFrame([("t", 5.0, 9)], PEOPLE).write.parquet(f"{root}/p")
    plan = cleaning.clean_ratings(spark.read.parquet(f"{root}/p"))._jdf.queryExecution()
    assert "GreaterThanOrEqual(averageRating,1.0)" in plan.executedPlan().toString()


def test_cleaning_edges(spark):
    ratings = spark.createDataFrame(
        [("a", 1.0, 5), ("b", 10.0, 4), ("c", 0.9, 9), ("d", None, 9), ("e", 10.0, None)], PEOPLE)
    assert [r["tconst"] for r in cleaning.clean_ratings(ratings).collect()] == ["a"]
    crew = spark.createDataFrame([(" ", "x"), (None, "x"), ("\\N", "x"), ("t", "\\N")],
                                 "tconst string, directors string")
    assert [tuple(r) for r in cleaning.clean_crew(crew).collect()] == [("t", None)]


def test_second_date_spares_the_first(spark, root):
    df = spark.createDataFrame([("a", 5.0, 9)], PEOPLE)
    for run in (RUN, "2025-09-29 01:00:00", "2025-09-29 02:00:00"):
        sinks.write_layer(sinks.add_ingestion_metadata(df, run), f"{root}/layer")
    back = readers.read_layer(spark, f"{root}/layer")
    assert sorted(r["ingestion_day"] for r in back.collect()) == [28, 29]


def test_date_layout_is_zero_padded(spark, root):
    df = spark.createDataFrame([("a", 5.0, 9)], PEOPLE)
    sinks.write_layer(sinks.add_ingestion_metadata(df, RUN), f"{root}/layer", layout="ymd")
    assert os.path.isdir(f"{root}/layer/year=2025/month=09/day=28")
    with pytest.raises(ValueError):
        sinks.write_layer(df, f"{root}/layer", layout="other")


def test_partition_filter_prunes(spark, root):
    df = spark.createDataFrame([("a", 5.0, 9)], PEOPLE)
    sinks.write_layer(sinks.add_ingestion_metadata(df, RUN), f"{root}/layer")
    query = readers.read_layer(spark, f"{root}/layer").where("ingestion_day = 28")
    plan = query._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ingestion_day" in plan


def test_catalog_sees_later_partitions(spark, root):
    df = spark.createDataFrame([("a", 5.0, 9)], PEOPLE)
    sinks.write_layer(sinks.add_ingestion_metadata(df, RUN), f"{root}/layer")
    schema = readers.read_layer(spark, f"{root}/layer").schema
    full = catalog.register_table(spark, "tests_db", "ratings_trusted", schema, f"{root}/layer")
    sinks.write_layer(sinks.add_ingestion_metadata(df, "2025-10-01 00:00:00"), f"{root}/layer")
    assert catalog.repair_table(spark, full).count() == 2
    assert catalog.register_table(
        spark, "tests_db", "ratings_trusted", schema, f"{root}/layer") == full
    assert [c.name for c in spark.catalog.listColumns(full) if c.isPartition] == list(
        PARTITION_COLUMNS)


def test_bucketed_tables_join_without_shuffle(spark, root):
    spark.sql("create database if not exists tests_db")
    for name in ("left", "right"):
        df = spark.range(1000).select(F.concat(F.lit("tt"), "id").alias("tconst"),
                                      F.col("id").alias(name))
        sinks.write_bucketed(df, f"tests_db.bucketed_{name}", f"{root}/{name}", "tconst", 4)
    joined = spark.table("tests_db.bucketed_left").hint("merge").join(
        spark.table("tests_db.bucketed_right"), "tconst")
    assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    assert joined.count() == 1000


def test_audit_counts_rows_and_files(spark, root):
    spark.range(10).repartition(3).write.parquet(f"{root}/trusted/a")
    got = {tuple(r) for r in audit.audit_layers(spark, {
        ("a", "trusted"): f"{root}/trusted/a", ("a", "refined"): f"{root}/refined/a"}).collect()}
    assert got == {("a", "trusted", 10, 3, True), ("a", "refined", 0, 0, False)}


def test_run_table_skips_and_forces(spark, root):
    path = f"{root}/raw/title.ratings.tsv.gz"
    put(path, "tconst\taverageRating\tnumVotes\n" + "".join(
        f"tt{i}\t{1 + i % 9}.5\t{i}\n" for i in range(1, 101)))
    cfg = RunConfig(root, RUN, 2024, database="tests_db_runs")
    assert [run_table(spark, "ratings", cfg, path, force=f)
            for f in (False, False, True)] == [True, False, True]
    refined = readers.read_layer(spark, f"{root}/refined/ratings")
    trusted = readers.read_layer(spark, f"{root}/trusted/ratings")
    assert refined.count() == trusted.count() > 0
    votes = sorted(r["numVotes"] for r in trusted.collect())
    cut = votes[int(0.8 * (len(votes) - 1))]
    popular = {r["numVotes"] for r in refined.where("is_popular = 1").collect()}
    assert popular == {v for v in votes if v > cut} | ({cut} if cut in popular else set())


def test_csv_values_with_line_breaks(spark, root):
    os.makedirs(root)
    with open(f"{root}/a.csv", "w") as f:
        f.write('id,title\n1,"two\nlines, ""quoted"""\n2,plain\n')
    got = readers.read_csv(spark, f"{root}/a.csv", "id int, title string").collect()
    assert [(r["id"], r["title"]) for r in got] == [(1, 'two\nlines, "quoted"'), (2, "plain")]


def test_workspaces_are_dropped(spark):
    path = session.workspace(spark, "gone")
    spark.range(3).write.parquet(path)
    other = f"{session.shared_dir(spark)}/mine"
    spark.range(3).write.parquet(other)
    assert path.startswith(session.shared_dir(spark)) and spark.read.parquet(path).count() == 3
    session.drop_workspaces(spark)
    assert not os.path.exists(path) and spark.read.parquet(other).count() == 3


def test_a_local_session_has_a_folder_without_settings():
    code = ("from cinestrata.session import local_session, materialised\n"
            "s = local_session(1)\nprint(materialised(s.range(3), 'x').count())")
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300)
    assert out.stdout.strip() == "3", out.stderr[-2000:]
