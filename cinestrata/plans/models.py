"""Regression models: Spark MLlib learners, simple mean predictors, ensembles, folds."""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce
from typing import Protocol

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.regression import (
    GBTRegressor, LinearRegression, RandomForestRegressionModel, RandomForestRegressor)
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cinestrata.operators.lookup import attach_stats
from cinestrata.operators.ordering import bucket
from cinestrata.operators.scaling import product_sql, product_terms
from cinestrata.plans.assembly import LABEL
from cinestrata.plans.evaluation import metrics
from cinestrata.session import checkpointed, ensure_checkpoint_dir, materialised

PREDICTION = "prediction"
# A share of the rows that a caller may put into ``min_leaf`` to bound a tree by 1 / share leaves.
# No forest does so by itself: its leaves are as small as its settings say, at any size.
LEAF_SHARE = 1e-4
# Tree learners run a job per level and tree over all rows; tasks with fewer rows than this are
# mostly overhead.
TASK_ROWS = 20_000
# Least and most rows in a task that grows a forest; its jobs do a level of all trees.
FOREST_ROWS = (8_000, 500_000)
# Least trees that are grown together; a forest grows in shares of so many, at any size.
SHARE_TREES = 8


class Predictor(Protocol):
    """Anything that adds a ``prediction`` column to a frame."""

    def transform(self, df: DataFrame) -> DataFrame: ...


def _fit(train: DataFrame, features: Sequence[str], learner) -> PipelineModel:
    """Fit the learner on the columns, or on the one vector column named."""
    ensure_checkpoint_dir(train.sparkSession)
    if len(features) == 1 and isinstance(train.schema[features[0]].dataType, VectorUDT):
        return Pipeline(stages=[learner.setFeaturesCol(features[0])]).fit(train)
    assemble = VectorAssembler(inputCols=list(features), outputCol="features",
                               handleInvalid="keep")
    return Pipeline(stages=[assemble, learner]).fit(train)


def _packed(train: DataFrame, rows: int) -> DataFrame:
    """Few partitions for few rows, without a shuffle; large frames stay as they are."""
    return train.coalesce(max(1, math.ceil(rows / TASK_ROWS)))


def _spread(train: DataFrame, rows: int, shares: int = 1) -> DataFrame:
    """Equal tasks for a forest's share: its part of the cores, if each has ``FOREST_ROWS``.

    Every task sums, sends and merges bins of every node of a level, however few its rows are, so
    more tasks than cores add work; scans of small files have fewer than there are cores.
    """
    least, most = FOREST_ROWS
    cores = math.ceil(train.sparkSession.sparkContext.defaultParallelism / shares)
    tasks = min(math.ceil(rows / least), max(cores, math.ceil(rows / most)))
    if tasks <= 1 and shares == 1:
        return _packed(train, rows)
    return train.repartition(max(1, tasks))


def _shares(cores: int, rows: int, trees: int) -> list[int]:
    """Trees of as many shares as keep the cores busy with large tasks, side by side.

    A node's bins are summed by every task of its share alone, so few large tasks per share do
    the least work. A forest of one task, or of few trees, is one share.
    """
    least, most = FOREST_ROWS
    n = 1 if rows <= least else min(trees // SHARE_TREES, math.ceil(cores / math.ceil(rows / most)))
    return _parts(trees, n)


def _parts(trees: int, n: int) -> list[int]:
    """So many trees in ``n`` nearly equal parts."""
    return [trees // n + (i < trees % n) for i in range(n)] if n > 1 else [trees]


def _grown(train: DataFrame, features: Sequence[str], learner: RandomForestRegressor,
           rows: int) -> PipelineModel:
    """A forest whose shares grow at the same time, each from bags of its own.

    Its shares follow the number of its trees alone. Rows and cores decide how many grow at a
    time, and in how many tasks each.
    """
    cores, trees = train.sparkSession.sparkContext.defaultParallelism, learner.getNumTrees()
    sizes = _parts(trees, trees // SHARE_TREES)
    if len(sizes) == 1:
        return _fit(_spread(train, rows), features, learner)
    busy = len(_shares(cores, max(rows, FOREST_ROWS[0] + 1), trees))
    # A task's bags follow its number too; a million seeds lie between two shares.
    learners = [learner.copy({learner.numTrees: n, learner.seed: learner.getSeed() + (i << 20)})
                for i, n in enumerate(sizes)]
    # Each share deals the rows for itself, or all would run where the one dealt copy lies. Twice
    # as many as keep the cores busy, since between two levels a share waits for the driver.
    with ThreadPoolExecutor(min(len(sizes), 2 * busy)) as pool:
        parts = list(pool.map(
            lambda one: _fit(_spread(train, rows, busy), features, one), learners))
    return PipelineModel([*parts[0].stages[:-1],
                          _united(train.sparkSession, learner, [p.stages[-1] for p in parts])])


def _united(spark: SparkSession, learner: RandomForestRegressor,
            forests: Sequence[RandomForestRegressionModel]) -> RandomForestRegressionModel:
    """One model of all the forests' trees, with the learner's settings."""
    kept = [t for f in forests for t in f._java_obj.trees()]
    made = spark._jvm.org.apache.spark.ml.regression
    trees = spark.sparkContext._gateway.new_array(made.DecisionTreeRegressionModel, len(kept))
    for i, tree in enumerate(kept):
        trees[i] = tree
    model = RandomForestRegressionModel(made.RandomForestRegressionModel(
        forests[0].uid, trees, forests[0].numFeatures))
    forests[0]._copyValues(model, {model.numTrees: len(kept), model.seed: learner.getSeed()})
    model._transfer_params_to_java()
    return model


def fit_linear(train: DataFrame, features: Sequence[str], label: str = LABEL) -> PipelineModel:
    """Ordinary least squares from one pass of normal equations."""
    return _fit(train, features, LinearRegression(labelCol=label, solver="normal"))


def fit_ridge(train: DataFrame, features: Sequence[str], label: str = LABEL,
              alpha: float = 1.0) -> PipelineModel:
    """L2 penalty ``alpha`` on the summed squared error.

    Spark divides the squared error by the row count and scales the label by its
    deviation, so its penalty is ``alpha * deviation / rows``.
    """
    row = train.agg(F.count(label).alias("n"), F.stddev_pop(label).alias("sd")).first()
    return _fit(train, features, LinearRegression(
        labelCol=label, solver="normal", standardization=False, elasticNetParam=0.0,
        regParam=alpha * row["sd"] / row["n"]))


def fit_lasso(train: DataFrame, features: Sequence[str], label: str = LABEL,
              alpha: float = 0.01) -> PipelineModel:
    """L1 penalty ``alpha`` on the mean squared error's half."""
    return _fit(train, features, LinearRegression(
        labelCol=label, standardization=False, elasticNetParam=1.0, regParam=alpha,
        maxIter=10_000, tol=1e-9))


def fit_forest(train: DataFrame, features: Sequence[str], label: str = LABEL,
               trees: int = 100, max_depth: int = 30, min_leaf: int = 1, max_bins: int = 64,
               seed: int = 42, bootstrap: bool = True) -> PipelineModel:
    """Random forest over all features per split; 30 is the deepest tree Spark grows.

    A leaf has at least ``min_leaf`` rows, however many there are, so the model grows with the
    data up to the depth. Each row keeps the node it is in, so that a level's jobs carry the
    nodes to split and not the trees grown so far.
    """
    rows = train.count()
    needed = train.select(*(f"`{c}`" for c in dict.fromkeys([label, *features])))
    return _grown(needed, features, RandomForestRegressor(
        labelCol=label, numTrees=trees, maxDepth=max_depth, minInstancesPerNode=min_leaf,
        featureSubsetStrategy="all", maxBins=max_bins, maxMemoryInMB=512, seed=seed,
        bootstrap=bootstrap, cacheNodeIds=True, checkpointInterval=10), rows)


def fit_forest_regularised(train: DataFrame, features: Sequence[str],
                           label: str = LABEL) -> PipelineModel:
    """The second forest: depth 15, at least ten rows per leaf."""
    return fit_forest(train, features, label, max_depth=15, min_leaf=10)


def fit_gbt(train: DataFrame, features: Sequence[str], label: str = LABEL, trees: int = 200,
            depth: int = 6, rate: float = 0.1, subsample: float = 0.8, min_leaf: int = 1,
            seed: int = 42) -> PipelineModel:
    """Gradient-boosted trees; lineage is cut through the checkpoint folder."""
    return _fit(_packed(train, train.count()), features, GBTRegressor(
        labelCol=label, maxIter=trees, maxDepth=depth, stepSize=rate,
        subsamplingRate=subsample, minInstancesPerNode=min_leaf, maxBins=64,
        maxMemoryInMB=1024, checkpointInterval=10, seed=seed))


def fit_gbt_careful(train: DataFrame, features: Sequence[str],
                    label: str = LABEL) -> PipelineModel:
    """The second boosting configuration: shallower, slower, larger leaves."""
    return fit_gbt(train, features, label, depth=5, rate=0.05, min_leaf=10)


@dataclass(frozen=True)
class PolynomialModel:
    """A regression over products of columns, kept as one vector column."""

    columns: tuple[str, ...]
    degree: int
    interactions_only: bool
    keep: tuple[str, ...]
    model: Predictor

    def transform(self, df: DataFrame) -> DataFrame:
        return self.model.transform(
            with_products(df, self.columns, self.degree, self.interactions_only, self.keep))


def with_products(df: DataFrame, columns: Sequence[str], degree: int,
                  interactions_only: bool = False, keep: Sequence[str] = (),
                  out: str = "products") -> DataFrame:
    """Add one vector with all products of up to ``degree`` columns, and the kept columns behind."""
    terms = product_terms(columns, degree, interactions_only)
    values = [product_sql(t) for t in terms] + [f"cast(`{c}` as double)" for c in keep]
    return df.withColumn(out, array_to_vector(F.expr(f"array({', '.join(values)})")))


def fit_poly(train: DataFrame, columns: Sequence[str], label: str = LABEL, degree: int = 3,
             interactions_only: bool = False,
             base: Callable[[DataFrame, list[str], str], Predictor] = fit_linear,
             keep: Sequence[str] = ()) -> PolynomialModel:
    """Fit ``base`` on the products of the columns beside the untouched columns of ``keep``."""
    expanded = with_products(train, columns, degree, interactions_only, keep)
    return PolynomialModel(tuple(columns), degree, interactions_only, tuple(keep),
                           base(expanded, ["products"], label))


@dataclass(frozen=True)
class GroupMeanModel:
    """Predicts the training mean of the row's group; an unseen group gets the overall mean.

    Both are computed when the model is fitted: the means lie in the shared folder.
    """

    stats: DataFrame
    key: str
    overall: float | None

    def transform(self, df: DataFrame) -> DataFrame:
        scored = attach_stats(df, self.stats, self.key)
        overall = F.lit(self.overall).cast("double")
        return (scored.withColumn(PREDICTION, F.coalesce("__group_mean", overall))
                .drop("__group_mean"))


def fit_group_mean(train: DataFrame, key: str, label: str = LABEL) -> GroupMeanModel:
    stats = (train.where(F.col(key).isNotNull()).groupBy(key)
             .agg(F.avg(label).alias("__group_mean")))
    return GroupMeanModel(checkpointed(stats), key, train.agg(F.avg(label)).first()[0])


@dataclass(frozen=True)
class MeanModel:
    """Predicts the training mean everywhere."""

    mean: Column

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn(PREDICTION, self.mean)


def fit_mean(train: DataFrame, label: str = LABEL) -> MeanModel:
    return MeanModel(train.agg(F.avg(label)).scalar())


@dataclass(frozen=True)
class EnsembleModel:
    """Predicts the (weighted) mean of its models' predictions, one transform after the other."""

    models: tuple[Predictor, ...]
    weights: tuple[float, ...]

    def transform(self, df: DataFrame) -> DataFrame:
        original, parts = df.columns, []
        for i, model in enumerate(self.models):
            name = f"__prediction_{i}"
            parts.append(name)
            scored = model.transform(df).withColumnRenamed(PREDICTION, name)
            df = scored.select(*original, *parts)
        total = reduce(lambda a, b: a + b, [
            F.col(p) * w for p, w in zip(parts, self.weights)])
        return df.select(*original, (total / sum(self.weights)).alias(PREDICTION))


def combined(models: Sequence[Predictor],
             weights: Sequence[float] | None = None) -> EnsembleModel:
    """A predictor of the models' mean, to be folded, compared and scored like any other."""
    given = [1.0] * len(models) if weights is None else [float(w) for w in weights]
    if len(given) != len(models):
        raise ValueError(f"{len(given)} weights for {len(models)} models")
    return EnsembleModel(tuple(models), tuple(given))


def ensemble(df: DataFrame, models: Sequence[Predictor],
             weights: Sequence[float] | None = None) -> DataFrame:
    """``df`` with the (weighted) mean of the models' predictions."""
    return combined(models, weights).transform(df)


def _rows(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def coefficients(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """``(feature, coefficient)`` of a linear model, with its intercept."""
    names, fitted = model.stages[0].getInputCols(), model.stages[-1]
    rows = [(n, float(c)) for n, c in zip(names, fitted.coefficients.toArray())]
    return _rows(spark, rows + [("(intercept)", float(fitted.intercept))],
                 "feature string, coefficient double")


def selected_features(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """The features a lasso kept."""
    return coefficients(spark, model).where(
        (F.col("coefficient") != 0) & (F.col("feature") != "(intercept)"))


def importance(spark: SparkSession, model: PipelineModel, k: int = 10) -> DataFrame:
    """The k most important features of a tree model."""
    names, fitted = model.stages[0].getInputCols(), model.stages[-1]
    rows = [(n, float(v)) for n, v in zip(names, fitted.featureImportances.toArray())]
    return (_rows(spark, rows, "feature string, importance double")
            .orderBy(F.desc("importance"), "feature").limit(k))


def save_model(spark: SparkSession, model: PipelineModel, path: str, info: dict) -> None:
    """Write the model and a one-row metadata table beside it.

    ``info`` must name the model's ``features`` and its cross-validated R² (``r2_cv``, on its
    own or among ``metrics``), without which it cannot score; a ``timestamp`` is kept.
    """
    if not info.get("features") or cross_validated(info) is None:
        raise ValueError("info needs features and r2_cv")
    model.write().overwrite().save(f"{path}/model")
    _rows(spark, [(json.dumps(info, sort_keys=True),)], "info string").write.mode(
        "overwrite").parquet(f"{path}/info")


def cross_validated(info: dict) -> float | None:
    return info.get("r2_cv", info.get("metrics", {}).get("r2_cv"))


def load_model(spark: SparkSession, path: str) -> tuple[PipelineModel, dict]:
    info = json.loads(spark.read.parquet(f"{path}/info").first()["info"])
    return PipelineModel.load(f"{path}/model"), info


def kfold_by_fold(df: DataFrame, fit: Callable[[DataFrame], Predictor], k: int, key: str,
                  label: str = LABEL) -> DataFrame:
    """R² per fold; the fold of a row is the bucket of its key.

    Rows and folds are written once: what made the frame is not repeated for each fold.
    """
    df = materialised(df.withColumn("__fold", bucket(key, k)), "folds")
    fold, parts = F.col("__fold"), []
    for i in range(k):
        model = fit(df.where(fold != i))
        scored = model.transform(df.where(fold == i))
        parts.append(metrics(scored, label, PREDICTION).select(
            F.lit(i).alias("fold"), F.col("r2")))
    return reduce(DataFrame.unionByName, parts)


def kfold(df: DataFrame, fit: Callable[[DataFrame], Predictor], k: int = 5,
          key: str = "tconst", label: str = LABEL) -> DataFrame:
    """Mean, deviation, least and greatest R² over k folds."""
    return kfold_by_fold(df, fit, k, key, label).agg(
        F.count("r2").alias("folds"), F.avg("r2").alias("mean_r2"),
        F.stddev_pop("r2").alias("std_r2"), F.min("r2").alias("min_r2"),
        F.max("r2").alias("max_r2"))
