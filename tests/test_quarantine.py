import gzip
import os

import pytest

from cinestrata.sources import quarantine

HEADER = "tconst\taverageRating\tnumVotes"


def put(folder, name, lines, header=HEADER, compressed=True):
    os.makedirs(folder, exist_ok=True)
    data = ("\n".join([header, *lines]) + "\n").encode()
    with open(f"{folder}/{name}", "wb") as f:
        f.write(gzip.compress(data) if compressed else data)


def rejects(spark, root):
    return sorted((r["file"].rsplit("/", 1)[1], r["line"], r["reason"], r["text"])
                  for r in quarantine.read_rejects(spark, root).collect())


def test_lines_and_reasons(spark, tmp_path):
    root = str(tmp_path)
    put(f"{root}/raw/a", "one.tsv.gz", [
        "tt1\t5.5\t10", "", "tt2\t5.5", "tt3\tx\t10", "\\N\t5.0\t10", "tt4\t6.0\t\\N", "  \t6\t7",
        "tt5\t7.5\t1.5", "tt6\t7.5\t99\textra", "tt7\t8.5\t70"])
    put(f"{root}/raw/b", "two.tsv", ["tt8\t9.0\tmany"] + [f"tt{k}\t5.0\t20" for k in range(10, 15)]
        + ["broken"], compressed=False)
    quarantine.ingest_checked(spark, f"{root}/raw", "ratings", root)
    assert rejects(spark, root) == [
        ("one.tsv.gz", 4, "cells: 2 of 3", "tt2\t5.5"),
        ("one.tsv.gz", 5, "not double: averageRating", "tt3\tx\t10"),
        ("one.tsv.gz", 6, "no key: tconst", "\\N\t5.0\t10"),
        ("one.tsv.gz", 8, "no key: tconst", "  \t6\t7"),
        ("one.tsv.gz", 9, "not int: numVotes", "tt5\t7.5\t1.5"),
        ("one.tsv.gz", 10, "cells: 4 of 3", "tt6\t7.5\t99\textra"),
        ("two.tsv", 2, "not int: numVotes", "tt8\t9.0\tmany"),
        ("two.tsv", 8, "cells: 1 of 3", "broken")]
    files = {r["file"].rsplit("/", 1)[1]: (r["read"], r["good"], r["rejected"])
             for r in spark.read.parquet(f"{root}/counts").collect()}
    assert files == {"one.tsv.gz": (9, 3, 6), "two.tsv": (7, 5, 2)}
    assert {r["tconst"] for r in spark.read.parquet(f"{root}/rows").collect()} >= {"tt1", "tt7", "tt10"}


def test_lines_of_a_file_read_by_several_tasks(spark, tmp_path):
    root = str(tmp_path)
    lines = [f"tt{i}\t5.0\t{'x' if i % 1000 == 0 else 50}" for i in range(20_000)]
    put(f"{root}/raw", "long.tsv", lines, compressed=False)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        quarantine.ingest_checked(spark, f"{root}/raw", "ratings", root)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert [(r[1], r[3]) for r in rejects(spark, root)] == [
        (i + 2, lines[i]) for i in range(0, 20_000, 1000)]


def test_stream_takes_each_file_once_and_equals_a_batch(spark, tmp_path):
    root, batch = f"{tmp_path}/s", f"{tmp_path}/b"
    raw = f"{tmp_path}/raw"
    put(raw, "one.tsv.gz", ["tt1\t5.5\t10", "tt2"])
    quarantine.ingest_checked_stream(spark, raw, "ratings", root)
    put(raw, "two.tsv.gz", ["tt3\t5.5\t10", "tt4\t?\t10", "tt5\t8\t10"])
    quarantine.ingest_checked_stream(spark, raw, "ratings", root)
    quarantine.ingest_checked_stream(spark, raw, "ratings", root)
    quarantine.ingest_checked(spark, raw, "ratings", batch)
    assert rejects(spark, root) == rejects(spark, batch) and len(rejects(spark, root)) == 2
    for name, key in (("rows", "tconst"), ("counts", "file")):
        got, want = (sorted(r[key] for r in spark.read.parquet(f"{p}/{name}").collect())
                     for p in (root, batch))
        assert got == want


def test_repeated_batch_and_missing_header(spark, tmp_path):
    root, raw = str(tmp_path), f"{tmp_path}/raw"
    put(raw, "one.tsv.gz", ["tt1\t5.5\t10", "tt2"])
    for _ in range(2):
        quarantine.ingest_checked(spark, raw, "ratings", root, "day1")
    assert len(rejects(spark, root)) == 1 and spark.read.parquet(f"{root}/rows").count() == 1
    put(raw, "other.tsv.gz", ["tt3\t5.5\t10"], header="tconst\tnumVotes\taverageRating")
    with pytest.raises(ValueError, match="other.tsv.gz"):
        quarantine.ingest_checked(spark, raw, "ratings", root, "day2")
    assert quarantine.read_rejects(spark, f"{root}/none").collect() == []
