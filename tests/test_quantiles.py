"""Exact quantiles against numpy."""

import numpy as np
import pytest

from cinestrata.operators.quantiles import approx_quantile, exact_quantiles

PROBS = [0.0, 0.01, 0.25, 0.5, 0.8, 0.999, 1.0]
rng = np.random.default_rng(7)


@pytest.mark.parametrize("values", [
    rng.normal(size=3000),
    np.concatenate([np.full(1000, 5.0), rng.integers(0, 50, 2000)]),  # a third is one value
    rng.pareto(0.5, size=2000),                                        # heavy tail
    1.7e9 + rng.random(2000),                                          # narrow and far from 0
    np.array([-1.0, 0.0, 0.0, 1e-300, 1e300, -1e300]),
    np.array([42.0]),
    np.array([1.0, 2.0]),
], ids=["normal", "hot", "tail", "narrow", "extreme", "one", "two"])
def test_like_numpy(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "x double")
    got = {r["prob"]: r["value"] for r in exact_quantiles(df, "x", PROBS).collect()}
    assert set(got) == set(PROBS)
    for p in PROBS:
        assert got[p] == pytest.approx(np.quantile(values, p), rel=1e-12, abs=1e-12)


def test_nan_is_no_number_and_infinity_comes_last(spark):
    df = spark.createDataFrame(
        [(float("nan"),), (float("inf"),), (float("-inf"),), (1.0,), (2.0,)], "x double")
    got = {r["prob"]: r["value"] for r in exact_quantiles(df, "x", [0.0, 1 / 3, 1.0]).collect()}
    assert got == {0.0: float("-inf"), 1 / 3: 1.0, 1.0: float("inf")}


def test_no_values(spark):
    df = spark.createDataFrame([(None,)], "x double")
    assert exact_quantiles(df, "x", [0.5]).collect() == []


def test_approximate_is_within_its_error(spark):
    df = spark.range(10_000)
    value = approx_quantile(df, "id", 0.8).first()["value"]
    assert abs(value - 8000) <= 100
