import numpy as np
import pytest
from pyspark.sql import functions as F

from cinestrata.plans import gram


def frame(spark, n=500, seed=1):
    rng = np.random.default_rng(seed)
    x = np.column_stack([rng.normal(2000, 15, n), rng.exponential(1e5, n), rng.integers(0, 2, n)])
    y = 3 + 0.02 * x[:, 0] - 1e-6 * x[:, 1] + 2 * x[:, 2] + rng.normal(0, 1, n)
    rows = [(f"k{i}", *map(float, x[i]), float(y[i])) for i in range(n)]
    df = spark.createDataFrame(rows, "k string, `a-1` double, b double, c double, y double")
    return df.repartition(7), x, y


def design(x):
    return np.column_stack([np.ones(len(x)), x])


def test_fit_and_errors_equal_least_squares(spark):
    df, x, y = frame(spark)
    g = gram.whole(gram.grams(df, gram.columns_of(["a-1", "b", "c"]), "y"))
    fit = g.fit()
    best = np.linalg.lstsq(design(x), y, rcond=None)[0]
    assert np.allclose([fit.intercept, *fit.coefficients], best, rtol=1e-8)
    left = y - design(x) @ best
    got = g.errors(fit)
    assert got["n"] == 500 and np.isclose(got["mse"], (left ** 2).mean(), rtol=1e-9)
    assert np.isclose(got["r2"], 1 - (left ** 2).mean() / y.var(), rtol=1e-9)
    scored = {r["k"]: r["prediction"] for r in fit.transform(df).select("k", "prediction").collect()}
    assert np.allclose([scored[f"k{i}"] for i in range(500)], design(x) @ best)


def test_folds_by_subtraction_equal_fits_of_the_others(spark):
    df, x, y = frame(spark)
    fold = (F.substring("k", 2, 9).cast("int") % 4)
    parts = gram.grams(df, gram.columns_of(["a-1", "b", "c"]), "y", fold)
    assert list(parts) == [0, 1, 2, 3]
    total, at = gram.whole(parts), np.arange(500) % 4
    for f, part in parts.items():
        fit = (total - part).fit()
        best = np.linalg.lstsq(design(x[at != f]), y[at != f], rcond=None)[0]
        assert np.allclose([fit.intercept, *fit.coefficients], best, rtol=1e-7)
        left = y[at == f] - design(x[at == f]) @ best
        assert np.isclose(part.errors(fit)["r2"], 1 - (left ** 2).mean() / y[at == f].var())


def test_penalties(spark):
    df, x, y = frame(spark)
    g = gram.whole(gram.grams(df, gram.columns_of(["a-1", "b", "c"]), "y"))
    centred, label = x - x.mean(0), y - y.mean()
    for alpha in (0.5, 50.0):
        best = np.linalg.solve(centred.T @ centred + alpha * np.eye(3), centred.T @ label)
        assert np.allclose(g.fit(ridge=alpha).coefficients, best, rtol=1e-7)
    # The conditions that only the lasso solution fulfils.
    scaled = centred / x.std(0)
    for alpha in (0.01, 0.4):
        w = np.array(g.fit(lasso=alpha, scales=g.spread()).coefficients) * x.std(0)
        pull = scaled.T @ (label - scaled @ w) / 500
        assert np.allclose(pull[w != 0], alpha * np.sign(w[w != 0]), atol=1e-8)
        assert (np.abs(pull[w == 0]) <= alpha + 1e-8).all()
    assert not any(g.fit(lasso=100.0, scales=g.spread()).coefficients)


def test_dependent_constant_and_missing_columns(spark):
    df, x, y = frame(spark)
    df = df.select("*", (2024 - F.col("`a-1`")).alias("age"), F.lit(7.5).alias("same"),
                   F.lit(None).cast("double").alias("none"))
    names = ["a-1", "b", "c", "age", "same", "none"]
    fit = gram.fit_columns(df, names, "y")
    assert fit.coefficients[4:] == (0.0, 0.0)
    best = design(x) @ np.linalg.lstsq(design(x), y, rcond=None)[0]
    scored = {r["k"]: r["prediction"] for r in fit.transform(df).collect()}
    assert np.allclose([scored[f"k{i}"] for i in range(500)], best, rtol=1e-9)


def test_products_and_skipped_rows(spark):
    df, x, y = frame(spark)
    gone = df.select("k", *[F.col(f"`{c}`") for c in ("a-1", "b", "c")], F.lit(None).cast(
        "double").alias("y"))
    fit = gram.whole(gram.grams(df.union(gone), [("a-1",), ("b", "c")], "y")).fit()
    best = np.linalg.lstsq(design(np.column_stack([x[:, 0], x[:, 1] * x[:, 2]])), y, rcond=None)[0]
    assert np.allclose([fit.intercept, *fit.coefficients], best, rtol=1e-7)
    assert [r["feature"] for r in fit.table(spark).collect()] == ["a-1", "b*c", "(intercept)"]
    with pytest.raises(ValueError):
        gram.Gram((), np.zeros(1), np.zeros((2, 2))).fit()
    assert gram.grams(gone, [("b",)], "y") == {}


def test_wide_products_one_scan(spark):
    """987 products of 18 columns: fitted values equal those of least squares."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(1500, 18))
    y = x[:, 0] * x[:, 1] * x[:, 2] + rng.normal(size=1500)
    df = spark.createDataFrame([(*map(float, r), float(v)) for r, v in zip(x, y)],
                               ", ".join(f"c{i} double" for i in range(18)) + ", y double")
    from cinestrata.operators.scaling import product_terms

    terms = product_terms([f"c{i}" for i in range(18)], 3, interactions_only=True)
    assert len(terms) == 987
    g = gram.whole(gram.grams(df, terms, "y"))
    wide = np.column_stack([np.prod([x[:, int(c[1:])] for c in t], axis=0) for t in terms])
    left = y - design(wide) @ np.linalg.lstsq(design(wide), y, rcond=None)[0]
    assert np.isclose(g.errors(g.fit())["mse"], (left ** 2).mean(), rtol=1e-6)
