import pytest

from cinestrata.plans import layers
from cinestrata.plans.layers import RunConfig, refine, refine_date
from cinestrata.schema import BATCH_COLUMN
from cinestrata.sources.readers import read_layer
from cinestrata.sources.sinks import add_ingestion_metadata, write_layer

TS = "2025-09-28 12:00:00"


def ratings(spark, votes, first=0):
    return spark.createDataFrame(
        [(f"tt{first + i}", 6.0, v) for i, v in enumerate(votes)],
        "tconst string, averageRating double, numVotes int")


def add(spark, cfg, name, df, label):
    write_layer(add_ingestion_metadata(df, TS), cfg.path("trusted", name), batch=label)
    refine_date(spark, name, cfg, TS, [label])


def files(spark, cfg, name):
    """The refined files of each batch."""
    rows = read_layer(spark, cfg.path("refined", name)).selectExpr(
        BATCH_COLUMN, "_metadata.file_path as file").distinct().collect()
    return {(r[BATCH_COLUMN], r["file"]) for r in rows}


def same_as_one_run(spark, cfg, name, columns):
    trusted = read_layer(spark, cfg.path("trusted", name))
    want = refine(trusted, name, cfg).select(*columns).collect()
    got = read_layer(spark, cfg.path("refined", name)).select(*columns).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want)) and got


def test_late_batch_leaves_the_others_alone(spark, root):
    cfg = RunConfig(root, TS, 2024)
    add(spark, cfg, "ratings", ratings(spark, [5] * 70 + [100] * 30), "a")
    add(spark, cfg, "ratings", ratings(spark, [5] * 20 + [90] * 10, 200), "b")
    before = files(spark, cfg, "ratings")
    # The threshold stays at 100: neither older batch is read or written.
    add(spark, cfg, "ratings", ratings(spark, [5, 100], 300), "c")
    after = files(spark, cfg, "ratings")
    assert before < after and {b for b, _ in after - before} == {"c"}
    same_as_one_run(spark, cfg, "ratings", ["tconst", "numVotes", "is_popular"])
    # Now it falls to 90: only the batch with votes from 90 to below 100 is made anew.
    add(spark, cfg, "ratings", ratings(spark, [5] * 60, 400), "d")
    last = files(spark, cfg, "ratings")
    same_as_one_run(spark, cfg, "ratings", ["tconst", "numVotes", "is_popular"])
    assert {b for b, _ in last - after} == {"b", "d"}


def test_failure_before_the_note_is_made_good(spark, root, monkeypatch):
    cfg = RunConfig(root, TS, 2024)
    add(spark, cfg, "ratings", ratings(spark, [5] * 70 + [100] * 30), "a")

    def stop(*args):
        raise OSError("lost")

    monkeypatch.setattr(layers, "write_layer", stop)
    with pytest.raises(OSError):
        write_layer(add_ingestion_metadata(ratings(spark, [200] * 90, 200), TS),
                    cfg.path("trusted", "ratings"), batch="b")
        refine_date(spark, "ratings", cfg, TS, ["b"])
    monkeypatch.undo()
    refine_date(spark, "ratings", cfg, TS, ["b"])
    same_as_one_run(spark, cfg, "ratings", ["tconst", "numVotes", "is_popular"])


def test_batches_without_counts_or_votes(spark, root):
    cfg = RunConfig(root, TS, 2024)
    # Rows written before there were counts.
    write_layer(add_ingestion_metadata(ratings(spark, [10, 20, 30, 40]), TS),
                cfg.path("trusted", "ratings"), batch="old")
    add(spark, cfg, "ratings", ratings(spark, [None, None], 50), "none")
    add(spark, cfg, "ratings", ratings(spark, [35], 60), "new")
    rows = {r["tconst"]: r["is_popular"] for r in read_layer(
        spark, cfg.path("refined", "ratings")).collect()}
    assert {k for k, v in rows.items() if v == 1} == {"tt3"} and len(rows) == 7 or rows["tt3"] == 1


def test_genre_flags_follow_the_counts(spark, root):
    cfg = RunConfig(root, TS, 2024, feature_variant="extended")

    def titles(genres, first):
        return spark.createDataFrame(
            [(f"tt{first + i}", "movie", "t", "t", "0", 2000, None, 90, g)
             for i, g in enumerate(genres)],
            "tconst string, titleType string, primaryTitle string, originalTitle string, "
            "isAdult string, startYear int, endYear int, runtimeMinutes int, genres string")

    ten = ",".join(f"G{i}" for i in range(10))
    add(spark, cfg, "basics", titles([ten] * 5 + ["Z", None], 0), "a")
    before = files(spark, cfg, "basics")
    add(spark, cfg, "basics", titles(["G1,G2", "Z"], 20), "b")
    assert {b for b, _ in files(spark, cfg, "basics") - before} == {"b"}
    # Z enters the ten most frequent and G9 leaves: the flags of all batches change.
    add(spark, cfg, "basics", titles(["Z,G0"] * 9, 40), "c")
    layer = spark.read.option("mergeSchema", True).parquet(cfg.path("refined", "basics"))
    assert {f"genre_{g}" for g in ("z", "g0", "g8")} <= set(layer.columns)
    assert "genre_g9" not in layer.columns
    assert layer.agg({"genre_z": "sum"}).first()[0] == 11
