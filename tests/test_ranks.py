import math

import numpy as np
from pyspark.ml.stat import KolmogorovSmirnovTest
from pyspark.sql import functions as F

from cinestrata.operators import ranks, sketches


def test_ranks_equal_sorting(spark):
    rng = np.random.default_rng(2)
    values = [float(v) for v in np.concatenate([rng.integers(-5, 5, 900), rng.normal(size=300)])]
    values += [None, float("nan"), 0.0, -0.0, float("inf"), -float("inf")]
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(6)
    got = sorted((r["value"], r["n"], r["below"]) for r in ranks.value_ranks(df, "v").collect())
    held = sorted(v for v in values if v is not None and not math.isnan(v))
    want = [(v, held.count(v), sum(h < v for h in held)) for v in sorted(set(held))]
    assert got == want
    assert ranks.value_ranks(df.limit(0), "v").collect() == []


def test_values_are_spread_over_tasks(spark):
    plan = ranks.value_ranks(spark.range(50_000), "id")
    placed = plan.groupBy((F.col("below") * 8 / 50_000).cast("int")).count().collect()
    assert len(placed) == 8
    text = plan._jdf.queryExecution().executedPlan().toString()
    # The only window without a key runs over one row per partition.
    assert "broadcast" in text.lower()


def test_distance_equals_the_library(spark):
    rng = np.random.default_rng(4)
    for values in (rng.normal(3, 2, 700), np.round(rng.exponential(1, 500), 1), np.ones(1)):
        df = spark.createDataFrame([(float(v),) for v in values], "r double")
        want = KolmogorovSmirnovTest.test(df, "r", "norm", 1.0, 2.0).first()["statistic"]
        got = ranks.empirical_distance(df, "r", F.lit(1.0), F.lit(2.0)).first()
        assert got["n"] == len(values) and abs(got["statistic"] - want) < 1e-12


def test_normal_distribution(spark):
    x = [k / 50 for k in range(-500, 501)] + [-40.0, 40.0]
    df = spark.createDataFrame([(v,) for v in x], "x double")
    for r in df.select("x", F.expr(ranks.normal_cdf("x")).alias("p")).collect():
        assert abs(r["p"] - 0.5 * math.erfc(-r["x"] / math.sqrt(2))) < 1e-14


def within(values, estimate, p, error):
    values = np.sort(values)
    low = np.searchsorted(values, estimate, "left") / len(values)
    high = np.searchsorted(values, estimate, "right") / len(values)
    return low - error <= p <= high + error


def test_sketches_of_batches_merge(spark, root):
    rng = np.random.default_rng(9)
    batches = [rng.lognormal(3, 2, n) for n in (30_000, 5_000, 1, 12_000)]
    store = sketches.SketchStore(spark, f"{root}/votes", "v", size=256)
    assert store.quantile(0.8) is None
    for i, values in enumerate(batches):
        df = spark.createDataFrame([(float(v),) for v in values], "v double").repartition(3)
        store.add(df, f"b{i}")
    everything = np.concatenate(batches)
    error = sketches.rank_error(256)
    for p in (0.0, 0.05, 0.5, 0.8, 0.99, 1.0):
        assert within(everything, store.quantile(p), p, error)
    # A batch that comes again replaces its own sketch and no other.
    again = spark.createDataFrame([(float(v),) for v in np.full(40_000, 1e9)], "v double")
    store.add(again, "b1")
    rows = {r["batch"]: r["n"] for r in store.batches().collect()}
    assert rows == {"b0": 30_000, "b1": 40_000, "b2": 1, "b3": 12_000}
    assert store.quantile(0.8) == 1e9
    store.add(again.limit(0), "b1")
    assert store.quantile(1.0) < 1e9 or store.batches().where("batch = 'b1'").count() == 1


def test_groups_and_missing_values(spark):
    df = spark.createDataFrame([("x", 1.0), ("x", None), ("x", float("nan")), ("y", 5.0), ("y", 7.0),
                                ("z", None)], "g string, v double")
    by = sketches.sketched(df, "v", ["g"])
    assert {r["g"]: r["n"] for r in by.collect()} == {"x": 1, "y": 2}
    both = sketches.merged(by)
    got = {r["prob"]: r["value"] for r in sketches.quantiles(both, [0.0, 0.5, 1.0]).collect()}
    assert got == {0.0: 1.0, 0.5: 5.0, 1.0: 7.0}
    assert sketches.quantiles(sketches.sketched(df.limit(0), "v"), [0.5]).collect() == []
