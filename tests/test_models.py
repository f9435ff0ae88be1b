"""Models, evaluation and scoring on data whose answer is known."""

import numpy as np
import pytest
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from cinestrata.plans import evaluation, models, scoring
from cinestrata.session import materialised


@pytest.fixture(scope="module")
def data(spark):
    """A target that depends on two features, with a little noise."""
    rng = np.random.default_rng(3)
    a, b = rng.normal(size=600), rng.normal(size=600)
    y = 6 + 1.5 * a - 0.5 * b + rng.normal(scale=0.1, size=600)
    frame = [(f"t{i}", float(a[i]), float(b[i]), float(y[i]), f"g{i % 3}") for i in range(600)]
    return materialised(spark.createDataFrame(
        frame, "tconst string, a double, b double, averageRating double, g string"), "data")


def r2(model, df):
    return evaluation.metrics(model.transform(df), "averageRating", "prediction").first()["r2"]


def matrix(data):
    rows = data.collect()
    x = np.array([[r["a"], r["b"]] for r in rows])
    y = np.array([r["averageRating"] for r in rows])
    return x, y


def test_linear_and_ridge_equal_closed_forms(spark, data):
    x, y = matrix(data)
    xc, yc = x - x.mean(0), y - y.mean()
    for model, alpha in ((models.fit_linear(data, ["a", "b"]), 0.0),
                         (models.fit_ridge(data, ["a", "b"], alpha=50.0), 50.0)):
        want = np.linalg.solve(xc.T @ xc + alpha * np.eye(2), xc.T @ yc)
        assert np.allclose(model.stages[-1].coefficients.toArray(), want, atol=1e-6)


def test_strong_lasso_drops_the_weak_feature(spark, data):
    model = models.fit_lasso(data, ["a", "b"], alpha=0.8)
    kept = [r["feature"] for r in models.selected_features(spark, model).collect()]
    assert kept == ["a"]


@pytest.mark.parametrize("fit", [
    lambda d: models.fit_forest(d, ["a", "b"], trees=10, max_depth=8),
    lambda d: models.fit_gbt(d, ["a", "b"], trees=10, depth=3),
    lambda d: models.fit_poly(d, ["a", "b"], degree=2),
], ids=["forest", "gbt", "poly"])
def test_learners_beat_the_mean(spark, data, fit):
    assert r2(fit(data), data) > 0.6 > r2(models.fit_mean(data), data) - 1e-9


def test_importance_and_roundtrip(spark, data, root):
    model = models.fit_forest(data, ["a", "b"], trees=5, max_depth=5)
    assert models.importance(spark, model, 1).first()["feature"] == "a"
    models.save_model(spark, model, root, {"features": ["a", "b"], "r2_cv": 0.4})
    loaded, info = models.load_model(spark, root)
    assert info == {"features": ["a", "b"], "r2_cv": 0.4} and r2(loaded, data) == r2(model, data)


def test_unseen_group_gets_the_overall_mean(spark, data):
    model = models.fit_group_mean(data.where("g <> 'g2'"), "g")
    mean = data.where("g <> 'g2'").agg(F.avg("averageRating")).first()[0]
    got = {r["prediction"] for r in model.transform(data.where("g = 'g2'")).collect()}
    assert list(got) == [pytest.approx(mean)]


def test_ensemble_weights(spark, data):
    class Constant:
        def __init__(self, v):
            self.v = v

        def transform(self, df):
            return df.withColumn("prediction", F.lit(self.v))

    parts = [Constant(1.0), Constant(4.0)]
    assert models.ensemble(data, parts).first()["prediction"] == 2.5
    assert models.ensemble(data, parts, [2, 1]).first()["prediction"] == 2.0


def test_kfold(spark, data):
    got = models.kfold(data, lambda d: models.fit_linear(d, ["a", "b"]), 3).first()
    assert got["folds"] == 3 and 0.99 < got["min_r2"] <= got["mean_r2"] <= got["max_r2"]


def test_normal_noise_passes_the_normality_test(spark, data):
    scored = models.fit_linear(data, ["a", "b"]).transform(data)
    assert evaluation.ks_test(scored, "averageRating", "prediction").first()["p_value"] > 0.01


def test_verdicts(spark):
    def row(r2):
        return spark.createDataFrame([(r2,)], "r2 double")

    for train, test, verdict, level in ((0.9, 0.5, "overfitting", "strong"),
                                        (0.2, 0.21, "underfitting", "none"),
                                        (0.5, 0.43, "balanced", "slight")):
        got = evaluation.overfit_verdict(row(train), row(test)).first()
        assert (got["verdict"], got["overfit_level"]) == (verdict, level)


def test_sample_request(spark):
    body = ('{"movies": [{"numVotes": 52, "log_votes": 3.5, "rating_normalized": 0.25, '
            '"rating_category": "good", "is_popular": 0}]}')
    df = spark.createDataFrame([("r1", body)], "id string, body string")
    row = scoring.requests(df, "body").first()
    assert (row["id"], row["numVotes"], row["rating_category"]) == ("r1", "52", "good")

    class Eight:
        def transform(self, frame):
            return frame.withColumn("prediction", F.lit(8.0))

    out = scoring.score(scoring.requests(df, "body"), Eight(), 0.41,
                        ["numVotes", "cat_good", "cat_poor", "pop_0"], keep=["id"]).first()
    assert out["confidence"] == 0.451 and out["rating_category"] == "very_good"
    assert (out["opportunity_score"], out["opportunity_level"]) == (228.57, "HIGH")
    assert out["error"] is None


def test_bad_row_reports_an_error(spark):
    class Five:
        def transform(self, frame):
            return frame.withColumn("prediction", F.lit(5.0))

    df = spark.createDataFrame([("t1", "n/a"), ("t2", "10")], "tconst string, numVotes string")
    got = {r["tconst"]: (r["predicted_rating"], r["error"])
           for r in scoring.score(df, Five(), 0.4, ["numVotes"]).collect()}
    assert got == {"t1": (None, "not a number: numVotes"), "t2": (5.0, None)}


def test_confidence_is_capped(spark):
    df = spark.createDataFrame([(6.0,), (9.0,)], "p double")
    got = [r[0] for r in df.select(scoring.confidence(F.col("p"), 0.99)).collect()]
    assert got == [0.95, 0.891]


def test_opportunity_without_votes(spark):
    df = spark.createDataFrame([(8.0, 0.0, 0), (8.0, None, None), (6.0, 5.0, 0), (8.0, 5.0, 1)],
                               "p double, v double, pop int")
    got = [(r[0]["score"], r[0]["level"]) for r in df.select(
        scoring.opportunity(F.col("p"), F.col("v"), F.col("pop"))).collect()]
    assert got == [(None, None), (160.0, "HIGH"), (0.0, "LOW"), (0.0, "LOW")]


def test_saved_models_need_what_scoring_needs(spark, data, root):
    model = models.fit_linear(data, ["a"])
    for info in ({"features": ["a"]}, {"r2_cv": 0.4}, {}):
        with pytest.raises(ValueError):
            models.save_model(spark, model, root, info)
    models.save_model(spark, model, root, {"features": ["a"], "metrics": {"r2_cv": 0.4},
                                           "timestamp": "2025-09-28"})
    rows = spark.createDataFrame([("t1", "2"), ("t2", "two"), ("t3", None)], "tconst string, a string")
    got = {r["tconst"]: r for r in scoring.score_saved(rows, root).collect()}
    assert got["t1"]["error"] is None and got["t1"]["record"] is None
    assert got["t2"]["predicted_rating"] is None and '"two"' in got["t2"]["record"]
    assert got["t3"]["confidence"] is not None
    assert {r["model_timestamp"] for r in got.values()} == {"2025-09-28"}


def test_ensembles_are_predictors(spark, data):
    def fit(train):
        return models.combined([models.fit_linear(train, ["a", "b"]), models.fit_mean(train)], [3, 1])

    keyed = data.withColumn("tconst", F.monotonically_increasing_id().cast("string"))
    assert models.kfold(keyed, fit, 3).first()["folds"] == 3
    with pytest.raises(ValueError):
        models.combined([models.fit_mean(data)], [1, 2])


def test_products_beside_untouched_columns(spark, data):
    for base in (models.fit_linear, lambda d, f, y: models.fit_forest(d, f, y, trees=3, max_depth=4)):
        model = models.fit_poly(data, ["a"], degree=3, base=base, keep=["b"])
        assert r2(model, data) > 0.5


def test_metrics_leave_out_rows_without_prediction(spark):
    rows = [(1.0, 1.5), (2.0, 1.5), (3.0, 3.5), (90.0, None), (None, 4.0)]
    got = evaluation.metrics(spark.createDataFrame(rows, "y double, p double"), "y", "p").first()
    assert got["n"] == 3 and got["r2"] == pytest.approx(1 - 0.75 / 2)


def test_forest_keeps_node_ids_with_the_rows(spark, data):
    # Otherwise every level's jobs carry all trees grown so far.
    forest = models.fit_forest(data, ["a", "b"], trees=3, max_depth=6).stages[-1]
    assert forest.getCacheNodeIds()
    plain = RandomForestRegressor(
        labelCol="averageRating", numTrees=3, maxDepth=6, featureSubsetStrategy="all", maxBins=64,
        maxMemoryInMB=1024, seed=42)
    rows = models._packed(data, data.count())
    grown = models._fit(rows, ["a", "b"], plain).stages[-1]

    def splits(model):
        return [t.toDebugString.split("\n")[1:] for t in model.trees]

    assert splits(grown) == splits(forest)


def test_forests_grow_in_a_task_per_core(spark, monkeypatch):
    # A scan of one small file is one task, whatever the cluster has.
    monkeypatch.setattr(models, "FOREST_ROWS", (100, 1000))
    cores = spark.sparkContext.defaultParallelism

    def sizes(rows):
        train = spark.range(0, rows, 1, 1)
        tasks = models._spread(train, rows)
        assert tasks.count() == rows
        return [r["count"] for r in tasks.groupBy(F.spark_partition_id()).count().collect()]

    assert len(sizes(100)) == 1
    assert len(sizes(150)) == min(2, cores)
    assert len(sizes(100 * cores)) == len(sizes(200 * cores)) == cores
    many = sizes(1000 * cores + 1)
    assert len(many) == cores + 1 and max(many) < 2 * min(many)


def test_fitted_forests_are_spread(spark, data, monkeypatch):
    monkeypatch.setattr(models, "FOREST_ROWS", (100, 1000))
    seen, fit = [], models._fit
    monkeypatch.setattr(models, "_fit", lambda train, *rest: (seen.append(train), fit(train, *rest))[1])
    model = models.fit_forest(data.coalesce(1), ["a", "b"], trees=3, max_depth=6)
    assert seen[0].select(F.spark_partition_id()).distinct().count() == min(
        6, spark.sparkContext.defaultParallelism)
    assert r2(model, data) > 0.5


def test_shares_of_a_forest():
    least, most = models.FOREST_ROWS
    assert models._shares(12, least, 100) == [100]
    assert models._shares(12, most, 3) == [3]
    assert models._shares(1, most, 100) == [100]
    assert models._shares(8, most, 100) == [13] * 4 + [12] * 4
    assert models._shares(12, most + 1, 100) == [17] * 4 + [16] * 2
    assert models._shares(12, 12 * most, 100) == [100]


def test_a_forest_grows_in_shares(spark, data, root, monkeypatch):
    # In one forest every core's task sums bins of the nodes of all trees.
    monkeypatch.setattr(models, "FOREST_ROWS", (100, 1000))
    seen, fit = [], models._fit

    def noted(train, features, learner):
        seen.append((train.select(F.spark_partition_id()).distinct().count(),
                     learner.getNumTrees()))
        return fit(train, features, learner)

    monkeypatch.setattr(models, "_fit", noted)
    model = models.fit_forest(data, ["a", "b"], trees=40, max_depth=6)
    assert spark.sparkContext.defaultParallelism == 8
    assert seen == [(2, 8)] * 5
    forest = model.stages[-1]
    assert forest.getNumTrees == 40 and forest.getSeed() == 42 and forest.numFeatures == 2
    assert len({t.toDebugString.split("\n", 1)[1] for t in forest.trees}) == 40
    assert r2(model, data) > 0.5

    at = data.limit(20).collect()
    for row in model.transform(spark.createDataFrame(at, data.schema)).collect():
        votes = [t.predict(row["features"]) for t in forest.trees]
        assert row["prediction"] == pytest.approx(sum(votes) / 40)
    models.save_model(spark, model, f"{root}/shares", {"features": ["a", "b"], "r2_cv": 0.5})
    loaded = models.load_model(spark, f"{root}/shares")[0]
    assert loaded.stages[-1].getNumTrees == 40
    assert loaded.stages[-1].toDebugString.split("\n")[1:] == forest.toDebugString.split("\n")[1:]
    again = models.fit_forest(data, ["a", "b"], trees=40, max_depth=6).stages[-1]
    assert again.toDebugString.split("\n")[1:] == forest.toDebugString.split("\n")[1:]


def test_forests_of_any_size_have_leaves_of_the_given_size(spark):
    # Over 10,000 rows a leaf once had a ten-thousandth of the rows at least, here two and three.
    for rows in (9_000, 12_500, 22_500):
        grid = spark.range(rows).selectExpr(
            "cast(id % 50 as double) a", "cast(id div 50 % 50 as double) b", "id", "0.0d y")
        alone = grid.withColumn("y", F.when(F.col("id") == 503, 9.0).otherwise(0.0)).where(
            "id = 503 or not (a = 3 and b = 10)")
        model = models.fit_forest(alone, ["a", "b"], "y", trees=1, max_depth=30, bootstrap=False)
        assert model.stages[-1].getMinInstancesPerNode() == 1
        assert model.transform(alone.where("id = 503")).first()["prediction"] == 9.0
        assert model.transform(alone.where("id <> 503")).where("prediction <> 0").count() == 0


def test_shares_follow_the_trees_alone(spark, monkeypatch):
    # A forest of up to 8,000 rows was one share, of more rows several, with other bags.
    monkeypatch.setattr(models, "FOREST_ROWS", (100, 1000))
    seen, fit = [], models._fit
    monkeypatch.setattr(models, "_fit", lambda train, features, learner: (
        seen.append((learner.getSeed(), learner.getNumTrees())), fit(train, features, learner))[1])
    for rows in (50, 100, 101, 3000):
        data = spark.range(rows).selectExpr("cast(id as double) a", "cast(id % 7 as double) y")
        forest = models.fit_forest(data, ["a"], "y", trees=17, max_depth=2).stages[-1]
        assert sorted(seen) == [(42, 9), (42 + (1 << 20), 8)]
        assert forest.getNumTrees == 17 and forest.getSeed() == 42
        seen.clear()


def test_tasks_of_a_share_are_large():
    # Every task sums all bins of its share's nodes, however few rows each node has.
    assert len(models._shares(12, 443_566, 100)) == 12
    assert len(models._shares(12, 6_000_000, 100)) == 1
