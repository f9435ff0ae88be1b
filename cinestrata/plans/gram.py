"""Linear models from additive statistics: one scan sums products per fold, the rest is algebra.

The statistics of two sets of rows add up, so a fold's training part is the whole less the
fold, every penalty is solved from the same sums, and held-out errors need no second scan.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cinestrata.operators.ordering import bucket
from cinestrata.operators.scaling import product_sql
from cinestrata.plans.assembly import LABEL

PREDICTION = "prediction"
# Directions with less than this share of the greatest variance are taken as linear dependence.
RANK_TOLERANCE = 1e-10

Term = tuple[str, ...]


def _values(terms: Sequence[Term]) -> list[str]:
    """A term is a product of columns; a missing value counts as 0."""
    return [f"coalesce({product_sql(t)}, 0D)" for t in terms]


@dataclass(frozen=True)
class LinearFit:
    """A linear predictor over terms."""

    terms: tuple[Term, ...]
    coefficients: tuple[float, ...]
    intercept: float

    def transform(self, df: DataFrame) -> DataFrame:
        array = f"array({', '.join(_values(self.terms))})"
        weights = f"array({', '.join(f'{c!r}D' for c in self.coefficients)})"
        return df.withColumn(PREDICTION, F.expr(
            f"aggregate(zip_with({array}, {weights}, (x, w) -> x * w), {self.intercept!r}D, "
            "(total, p) -> total + p)"))

    def table(self, spark: SparkSession) -> DataFrame:
        """``(feature, coefficient)``, with the intercept."""
        rows = [("*".join(t), float(c)) for t, c in zip(self.terms, self.coefficients)]
        return spark.createDataFrame(rows + [("(intercept)", float(self.intercept))],
                                     "feature string, coefficient double")


@dataclass(frozen=True)
class Gram:
    """Sums of products of ``[1, terms, label]``, each less a shift that keeps the sums small."""

    terms: tuple[Term, ...]
    shift: np.ndarray
    sums: np.ndarray

    def _with(self, sums: np.ndarray) -> Gram:
        return Gram(self.terms, self.shift, sums)

    def __add__(self, other: Gram) -> Gram:
        return self._with(self.sums + other.sums)

    def __sub__(self, other: Gram) -> Gram:
        return self._with(self.sums - other.sums)

    @property
    def rows(self) -> int:
        return round(float(self.sums[0, 0]))

    def _moments(self) -> tuple[np.ndarray, np.ndarray]:
        """Means (less the shift) and covariances of terms and label."""
        mean = self.sums[0, 1:] / self.sums[0, 0]
        return mean, self.sums[1:, 1:] / self.sums[0, 0] - np.outer(mean, mean)

    def spread(self) -> np.ndarray:
        """The deviation of each term, 0 for a constant one."""
        deviation = np.sqrt(np.maximum(np.diag(self._moments()[1])[:-1], 0.0))
        # A constant is known by its sums: what is left of it is rounding.
        level = np.sqrt(np.diag(self.sums)[1:-1] / self.sums[0, 0])
        return np.where(deviation > 1e-7 * level, deviation, 0.0)

    def fit(self, ridge: float = 0.0, lasso: float = 0.0,
            scales: np.ndarray | None = None) -> LinearFit:
        """Least squares with an L2 penalty on the summed or an L1 penalty on half the mean error.

        Penalties are on the columns as they are, or divided by ``scales`` (such as the
        :meth:`spread`). Without a penalty linearly dependent columns share their weight (the
        shortest solution); a constant column gets none.
        """
        if not self.rows:
            raise ValueError("no rows with a label")
        if ridge and lasso:
            raise ValueError("one penalty at a time")
        (mean, cov), spread = self._moments(), self.spread()
        live = np.flatnonzero(spread)
        s = spread[live]
        a, b = cov[np.ix_(live, live)] / np.outer(s, s), cov[live, -1] / s
        unit = (1.0 if scales is None else np.asarray(scales)[live]) / s
        if lasso:
            w = _descend(a, b, lasso * unit)
        elif ridge:
            w = np.linalg.solve(a + np.diag(ridge * unit ** 2 / self.sums[0, 0]), b)
        else:
            w = _shortest(a, b)
        weights = np.zeros(len(self.terms))
        weights[live] = w / s
        intercept = (mean[-1] + self.shift[-1]) - weights @ (mean[:-1] + self.shift[:-1])
        return LinearFit(self.terms, tuple(map(float, weights)), float(intercept))

    def errors(self, fit: LinearFit) -> dict[str, float]:
        """``n, r2, mse, rmse`` of a fit over these rows, without reading them."""
        w = np.asarray(fit.coefficients)
        level = fit.intercept + w @ self.shift[:-1] - self.shift[-1]
        u = np.concatenate([[-level], -w, [1.0]])
        mse = float(u @ self.sums @ u / self.sums[0, 0])
        variance = float(self._moments()[1][-1, -1])
        return {"n": self.rows, "r2": 1 - mse / variance if variance > 0 else float("nan"),
                "mse": mse, "rmse": max(mse, 0.0) ** 0.5}


def _shortest(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    values, vectors = np.linalg.eigh(a)
    use = values > RANK_TOLERANCE * max(values.max(initial=0.0), 1e-300)
    kept = vectors[:, use]
    return kept @ ((kept.T @ b) / values[use])


def _descend(a: np.ndarray, b: np.ndarray, penalty: np.ndarray) -> np.ndarray:
    """Coordinate descent on the covariances until no weight moves."""
    w, left = np.zeros(len(b)), b.copy()
    for _ in range(100_000):
        moved = 0.0
        for j in range(len(b)):
            pull = left[j] + a[j, j] * w[j]
            new = np.sign(pull) * max(abs(pull) - penalty[j], 0.0) / a[j, j]
            step = new - w[j]
            if step:
                left -= a[:, j] * step
                w[j] = new
                moved = max(moved, abs(step))
        if moved < 1e-12:
            break
    return w


def grams(df: DataFrame, terms: Sequence[Term], label: str = LABEL,
          fold: Column | None = None) -> dict[int, Gram]:
    """The sums of each fold's rows (all rows are fold 0 without one), from one scan.

    A task adds up its rows by matrix products and hands on one matrix per fold; the matrices
    are summed by row with map-side combining. The driver gets ``folds * (terms + 2)²`` numbers,
    whatever the number of rows. Rows without a label or a fold are left out.
    """
    terms = tuple(tuple(t) for t in terms)
    array = f"array({', '.join([*_values(terms), f'cast(`{label}` as double)'])})"
    rows = df.where(F.col(f"`{label}`").isNotNull()).select(
        (F.lit(0) if fold is None else fold).cast("int").alias("fold"), F.expr(array).alias("v"))
    rows = rows.where("fold is not null")
    one = rows.select("v").first()
    # Any row of the data does as a shift: sums of small differences lose no digits.
    shift = np.array(one["v"]) if one else np.zeros(len(terms) + 1)
    width = len(shift) + 1

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            folds = batch.column("fold").to_numpy()
            v = np.ones((len(folds), width))
            v[:, 1:] = batch.column("v").flatten().to_numpy(
                zero_copy_only=False).reshape(len(folds), -1) - shift
            for f in np.unique(folds).tolist():
                part = v[folds == f]
                total[f] = total.get(f, 0) + part.T @ part
        for f, m in total.items():
            yield pa.RecordBatch.from_pydict(
                {"fold": pa.array([f] * width, pa.int32()), "i": pa.array(range(width), pa.int32()),
                 "v": pa.array(list(m), pa.list_(pa.float64()))})

    parts = rows.mapInArrow(summed, "fold int, i int, v array<double>")
    found = parts.groupBy("fold", "i").agg(
        Summarizer.sum(array_to_vector("v")).alias("v")).collect()
    out: dict[int, np.ndarray] = {}
    for r in found:
        out.setdefault(r["fold"], np.zeros((width, width)))[r["i"]] = r["v"].toArray()
    return {f: Gram(terms, shift, m) for f, m in sorted(out.items())}


def columns_of(names: Sequence[str]) -> list[Term]:
    """Terms of single columns."""
    return [(n,) for n in names]


def whole(parts: dict[int, Gram]) -> Gram:
    total, *more = parts.values()
    for g in more:
        total = total + g
    return total


def fit_columns(df: DataFrame, names: Sequence[str], label: str = LABEL, **penalty) -> LinearFit:
    """A linear model of columns, in one scan."""
    return whole(grams(df, columns_of(names), label)).fit(**penalty)


def fold_scores(spark: SparkSession, parts: dict[int, Gram], penalties: Sequence[float] = (0.0,),
                kind: str = "ridge") -> DataFrame:
    """``penalty, fold, r2``: each fold scored by the fit of all others, for every penalty.

    Penalties are on the columns divided by their deviation over all folds.
    """
    total = whole(parts)
    rows = [(float(p), f, part.errors((total - part).fit(**{kind: p}, scales=total.spread()))["r2"])
            for p in penalties for f, part in parts.items()]
    return spark.createDataFrame(rows, "penalty double, fold int, r2 double")


def cross_validated(df: DataFrame, names: Sequence[str], k: int = 5, key: str = "tconst",
                    label: str = LABEL, penalties: Sequence[float] = (0.0,),
                    kind: str = "ridge") -> DataFrame:
    """Mean, deviation, least and greatest R² over k folds for every penalty; one scan in all."""
    parts = grams(df, columns_of(names), label, bucket(key, k))
    scores = fold_scores(df.sparkSession, parts, penalties, kind)
    return scores.groupBy("penalty").agg(
        F.count("r2").alias("folds"), F.avg("r2").alias("mean_r2"),
        F.stddev_pop("r2").alias("std_r2"), F.min("r2").alias("min_r2"),
        F.max("r2").alias("max_r2"))
