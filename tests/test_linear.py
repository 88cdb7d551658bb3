"""Models from summed products against NumPy."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from portrisk import profiles as P
from portrisk.operators import linear
from portrisk.plans import forecast
from tests.conftest import plan_of

SCHEMA = "profile string, Date date, split string, window array<double>, target double"


def training(days, width, seed=1, profile="a"):
    rng = np.random.default_rng(seed)
    x = rng.random((days, width))
    y = x @ rng.normal(size=width) + 0.1 * rng.normal(size=days) + 3
    rows = [(profile, dt.date(2024, 1, 1) + dt.timedelta(d), "train", x[d].tolist(), float(y[d])) for d in range(days)]
    return x, y, rows


def ridge_by_hand(x, y, strength, picked, prior):
    c = x[:, picked] - x[:, picked].mean(axis=0)
    p = prior[picked]
    w = np.zeros(x.shape[1])
    w[picked] = p + np.linalg.solve(c.T @ c + strength * np.eye(len(picked)), c.T @ (y - y.mean() - c @ p))
    return y.mean() - x.mean(axis=0) @ w, w


def fit_by_hand(x, y):
    """The variant that errs least on the last fifth, fitted again on all rows."""
    width, n = x.shape[1], len(P.FEATURES)
    own = np.array([P.FEATURES[i % n] in forecast.OWN for i in range(width)])
    season = np.zeros(width)
    days = width // n
    if days >= forecast.SEASON:
        season[(days - forecast.SEASON + 1) * n - 1] = 1
    cut = len(y) - max(1, len(y) // 5)
    everything = np.arange(width)
    if cut < 2:
        return ridge_by_hand(x, y, forecast.RIDGES[0], everything, 0 * season)
    tried = [(s, pick, prior) for prior in (0 * season, season) for pick in (np.flatnonzero(own), everything) for s in forecast.RIDGES]

    def error(v):
        b, w = ridge_by_hand(x[:cut], y[:cut], *v)
        return np.abs(b + x[cut:] @ w - y[cut:]).mean()

    return ridge_by_hand(x, y, *min(tried, key=error))


def test_moments_equal_numpy_and_skip_bad_rows(spark):
    x, y, rows = training(30, 5)
    bad = [("a", None, "train", [None] * 5, 1.0), ("a", None, "train", [1.0] * 5, None), ("a", None, "train", None, 1.0), ("a", None, "train", [float("nan")] * 5, 1.0)]
    sums = linear.moments(spark.createDataFrame(rows + bad, SCHEMA).repartition(4), ["profile"])
    z = np.column_stack([np.ones(30), x, y])
    expected = z.T @ z
    got = {(r.i, r.j): r.value for r in linear.entries(sums, ["profile"]).collect()}
    assert got == {(i, j): pytest.approx(expected[i, j]) for i in range(7) for j in range(i, 7)}


@pytest.mark.parametrize("strength", [0.1, 100.0])
def test_ridge_equals_numpy(spark, strength):
    x, y, rows = training(40, 6)
    system = linear.centred(linear.moments(spark.createDataFrame(rows, SCHEMA), ["profile"]))
    got = linear.ridge(system, F.lit(strength), lambda i: i != 2, lambda i: F.when(i == 4, 1.0).otherwise(0.0)).first()
    b, w = ridge_by_hand(x, y, strength, np.array([0, 1, 3, 4, 5]), np.eye(6)[4])
    assert got.intercept == pytest.approx(b) and np.allclose(got.coefficients, w)


@pytest.mark.parametrize("days", [2, 3, 12, 60])
def test_fit_equals_numpy_for_each_profile(spark, days):
    lags = {"a": 1, "b": 7}
    made = {p: training(days, lags[p] * len(P.FEATURES), seed=days, profile=p) for p in lags}
    rows = [r for _, _, part in made.values() for r in part]
    rows += [("a", dt.date(2030, 1, 1), "test", [9.0] * len(P.FEATURES), 1e9)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    for r in forecast.fit_forecaster(df).collect():
        x, y, _ = made[r.profile]
        b, w = fit_by_hand(x, y)
        assert r.intercept == pytest.approx(b, abs=1e-6) and np.allclose(r.coefficients, w, atol=1e-6)


def test_fit_needs_no_python_and_sums_before_the_shuffle(spark):
    _, _, rows = training(10, len(P.FEATURES))
    plan = plan_of(forecast.training_moments(spark.createDataFrame(rows, SCHEMA)))
    assert "Python" not in plan and "Pandas" not in plan
    assert "partial_sum" in plan.lower() or "partial_aggregate_metrics" in plan.lower()


def test_no_rows_give_no_model(spark):
    assert forecast.fit_forecaster(spark.createDataFrame([], SCHEMA)).count() == 0
