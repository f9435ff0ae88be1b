"""Lookups, top-n, samples, aggregates, scaling."""

import hashlib

import pytest
from pyspark.sql import functions as F

from cinestrata.operators import aggregates, encoding, lookup, ordering, scaling


@pytest.fixture(scope="module")
def skewed(spark):
    """Nine thousand rows: a third has one key, a ninth has none."""
    key = (F.when(F.col("id") % 3 == 0, F.lit("hot"))
           .when(F.col("id") % 9 == 1, F.lit(None).cast("string"))
           .otherwise(F.concat(F.lit("k"), F.col("id") % 701)))
    return spark.range(9000).select("id", key.alias("key"), (F.col("id") % 10).alias("v"))


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_both_lookup_ways_agree(spark, skewed):
    stats = skewed.where("key is not null").groupBy("key").agg(F.avg("v").alias("mean"))
    small = lookup.attach_stats(skewed, stats, "key")
    large = lookup.attach_stats(skewed, stats, "key", broadcast_bytes=0)
    assert rows(small) == rows(large) == rows(skewed.join(stats, "key", "left"))
    plan = large._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" in plan
    found = skewed.stat.freqItems(["key"], lookup.HOT_SHARE).first()[0]
    assert "hot" in found and len(found) <= 1 / lookup.HOT_SHARE + 1


def test_group_count_leaves_missing_keys_alone(spark, skewed):
    got = lookup.with_group_count(skewed, "key", "n")
    assert {r["n"] for r in got.where("key = 'hot'").collect()} == {3000}
    assert {r["n"] for r in got.where("key is null").collect()} == {None}
    assert got.count() == 9000


def test_lookup_takes_the_first_ids(spark):
    df = spark.createDataFrame([(f"t{i}",) for i in range(20)], "tconst string")
    ids = [f"t{i}" for i in range(15)]
    assert lookup.lookup(df, ids, limit=10).count() == 10
    assert lookup.lookup(df, ["t3"]).count() == 1


def test_head_n_orders_few_more_than_n_rows(spark):
    df = spark.range(20_000).repartition(13).select(
        F.format_string("tt%07d", "id").alias("key"), (F.col("id") * 7919 % 977).alias("v"))
    df = df.union(spark.range(2).select(F.lit(None).cast("string"), "id"))
    for key in ("key", "v"):
        plain = df.orderBy(F.col(key).asc_nulls_last())
        for n in (0, 1, 1500, 20_001, 30_000):
            got = [r[key] for r in ordering.head_n(df, n, key).collect()]
            assert got == [r[key] for r in plain.limit(n).collect()]
    head = ordering.head_n(df, 5000, "key")
    plan = head._jdf.queryExecution().executedPlan().toString()
    assert "Coalesce" not in plan
    before = head._jdf.queryExecution().optimizedPlan().toString()
    assert "Filter" in before
    assert ordering.head_n(df.limit(0), 5, "key").count() == 0


@pytest.mark.parametrize("n", [0, 1, 700, 5000, 9999, 10_000, 20_000])
def test_sample_is_exact(spark, n):
    df = spark.range(10_000).select(F.concat(F.lit("t"), "id").alias("key"))
    keys = sorted((f"t{i}" for i in range(10_000)),
                  key=lambda k: (hashlib.md5(("s" + k).encode()).hexdigest(), k))
    got = {r["key"] for r in ordering.sample_n(df, n, "key", "s").collect()}
    assert got == set(keys[:n])


def test_rows_without_key_are_kept(spark):
    df = spark.createDataFrame([(None, i) for i in range(30)] + [("a", 30)], "key string, v int")
    assert ordering.sample_n(df, 100, "key").count() == 31
    assert ordering.sample_n(df, 20, "key").count() == 20
    train, test = ordering.split(df, "key", 50)
    assert train.count() + test.count() == 31


def test_split_is_a_partition(spark):
    df = spark.range(5000).select(F.col("id").cast("string").alias("key"))
    train, test = ordering.split(df, "key", 20)
    assert train.count() + test.count() == 5000
    assert train.join(test, "key").count() == 0
    assert 800 < test.count() < 1200
    assert "Exchange" not in train._jdf.queryExecution().executedPlan().toString()


def test_token_counts(spark):
    df = spark.createDataFrame([("b, a",), ("a",), ("\\N",), (None,), ("c,b",)], "genres string")
    assert rows(aggregates.top_tokens(df, "genres", 2)) == [("a", 2), ("b", 2)]
    assert aggregates.distinct_tokens(df, "genres").first()[0] == 3
    assert aggregates.top_names(df, "genres", 2, as_list=True) == ["a", "b"]


def test_value_counts_order_and_nulls(spark):
    df = spark.createDataFrame([("x",), ("y",), ("y",), (None,), ("w",)], "v string")
    got = aggregates.value_counts(df, "v").collect()
    assert [tuple(r) for r in got] == [("y", 2), ("w", 1), ("x", 1)]


def test_constant_columns(spark):
    df = spark.createDataFrame([(1, 5), (2, 5)], "id int, c int")
    assert {r["c_scaled"] for r in scaling.minmax(df, "c").collect()} == {None}
    assert {r["c"] for r in scaling.standardize(df, df, ["c"]).collect()} == {0.0}


def test_interaction_count(spark):
    df = spark.createDataFrame([tuple(range(18))], ", ".join(f"c{i} int" for i in range(18)))
    assert len(scaling.poly_interactions(df, df.columns, 3).columns) == 987
    powers = scaling.poly_expand(df.select("c2", "c3"), ["c2", "c3"], 2).first()
    assert powers.asDict() == {"c2": 2, "c3": 3, "c2*c2": 4, "c2*c3": 6, "c3*c3": 9}


def test_encoding_a_column_of_many_values(spark):
    df = spark.range(5000).select("id", F.concat(F.lit("v"), "id").alias("v"))
    assert encoding.one_hot(df, "v", "p", values=["v1", "v2"]).columns == ["id", "v", "p_v1", "p_v2"]
    names = encoding.categories(df, "v")
    assert len(names) == 5000 and names == sorted(names)
    vector = encoding.one_hot_vector(df, "v", "vec").transform(df)
    assert {r["vec"].size for r in vector.select("vec").collect()} >= {5001}


def test_sparse_vector_encoding(spark):
    df = spark.createDataFrame([("a",), ("b",), ("a",), (None,)], "v string")
    got = encoding.one_hot_vector(df, "v", "vec").transform(df).select("vec").collect()
    assert got[0]["vec"] == got[2]["vec"] != got[1]["vec"]


def test_head_n_with_outlying_keys(spark):
    keys = spark.range(60_000).select(F.format_string("tt%07d", F.col("id")).alias("key"))
    far = spark.createDataFrame([("a",), ("zz",), ("",), (None,), ("tt",), ("tt0",)], "key string")
    df = keys.union(far).repartition(5)
    want = sorted(["a", "", "tt", "tt0"] + [f"tt{i:07d}" for i in range(60_000)])
    for n in (1, 3, 4, 5, 777, 40_000):
        assert [r["key"] for r in ordering.head_n(df, n, "key").collect()] == want[:n]
    # The outliers do not keep the others together: few more than n rows are ordered.
    cut = ordering._text_cut(df, "key", 777)
    assert 777 <= sum(k.encode()[:len(cut)] <= cut for k in want) <= 2 * 777
    assert ordering._text_cut(df, "key", 70_000) is None
    got = [r["key"] for r in ordering.head_n(df, 70_000, "key").collect()]
    assert got[-1] is None and got[-2] == "zz" and len(got) == 60_006
    assert ordering.head_n(df, 0, "key").collect() == []


def test_head_n_with_one_frequent_key(spark):
    df = spark.createDataFrame([("same",)] * 900 + [("zero",), ("a",)], "key string")
    got = [r["key"] for r in ordering.head_n(df, 10, "key").collect()]
    assert got == ["a"] + ["same"] * 9
