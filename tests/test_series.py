"""Statistics, windows and forecasts against plain numpy and pandas."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from portrisk import profiles as P
from portrisk.operators import stats, windows
from portrisk.plans import features, forecast
from tests.conftest import plan_of


def series(spark, days=60, profiles=("CA02", "trans_atlantic"), seed=3):
    rng = np.random.default_rng(seed)
    rows = []
    for p in profiles:
        for d in range(days):
            day = dt.date(2024, 1, 1) + dt.timedelta(days=d)
            # a weekly pattern a model can learn
            news = int(20 + 8 * (d % 7) + rng.integers(0, 3))
            rows.append((p, day, news, *[float(x) for x in rng.uniform(0, 9, 4)], *[int(x) for x in rng.integers(0, 5, 7)]))
    names = ["profile string", "Date date", "NegativeNews long"]
    names += [f"{c} double" for c in P.TONE_FEATURES[1:]] + [f"{c} long" for c in P.DISRUPTION_COUNTS.values()]
    return spark.createDataFrame(rows, ", ".join(names))


def frame(spark, **options):
    changed = windows.difference(series(spark, **options)).where(F.col("Diff").isNotNull())
    return stats.winsorize(stats.split_train_test(changed, "2024-02-10")).select("profile", "Date", "split", *P.FEATURES)


def test_winsorize_equals_pandas(spark):
    changed = windows.difference(series(spark)).where(F.col("Diff").isNotNull())
    got = stats.winsorize(changed).toPandas().sort_values(["profile", "Date"])
    raw = changed.toPandas().sort_values(["profile", "Date"])
    want = raw.groupby("profile")["Diff"].transform(lambda s: s.clip(s.quantile(0.02), s.quantile(0.99)))
    assert np.allclose(got["Diff"].to_numpy(), want.to_numpy())


def test_winsorize_can_fit_on_train_or_approximate(spark):
    changed = stats.split_train_test(windows.difference(series(spark)), "2024-01-20")
    train = stats.winsorize(changed, fit_on="train").where("split = 'test'").agg(F.max("Diff")).first()[0]
    limit = changed.where("split = 'train'").toPandas().groupby("profile")["Diff"].quantile(0.99).max()
    assert train <= limit + 1e-9
    assert stats.winsorize(changed, approximate=True).count() == changed.count()


def test_scaling_round_trip_and_constant_column(spark):
    df = frame(spark).withColumn("PiracyNews", F.lit(4))
    limits = stats.minmax_fit(df, P.FEATURES)
    scaled = stats.minmax_transform(df, limits, P.FEATURES)
    train = scaled.where("split = 'train'").agg(F.min("Diff"), F.max("Diff"), F.max("PiracyNews")).first()
    assert tuple(train) == (0.0, 1.0, 0.0)
    back = stats.minmax_inverse(scaled, limits, {"Diff": "Back"}).select("profile", "Date", "Back")
    joined = df.join(back, ["profile", "Date"])
    assert joined.where(F.abs(F.col("Diff") - F.col("Back")) > 1e-9).count() == 0


def test_windows_hold_the_rows_before_and_stay_in_their_split(spark):
    made = windows.sliding_windows(frame(spark), 7, P.FEATURES)
    pdf = frame(spark).toPandas().sort_values(["profile", "Date"])
    for (profile, split), part in pdf.groupby(["profile", "split"]):
        got = made.where((F.col("profile") == profile) & (F.col("split") == split)).orderBy("Date").collect()
        assert len(got) == len(part) - 7
        values = part[list(P.FEATURES)].astype(float).to_numpy()
        for i, row in enumerate(got):
            assert np.allclose(row.window, values[i : i + 7].ravel())
            assert row.target == pytest.approx(values[i + 7, 12])


def test_each_profile_uses_its_own_window_length(spark):
    made, _ = features.scaled_windows(frame(spark))
    sizes = {r.profile: r.n for r in made.select("profile", F.size("window").alias("n")).distinct().collect()}
    assert sizes == {"CA02": 7 * 13, "trans_atlantic": 8 * 13}


def test_spearman_equals_pandas_and_guards(spark):
    rows = [("a", "x", float(v), float(w)) for v, w in [(1, 2), (2, 2), (2, 5), (4, 1), (5, 9)]]
    rows += [("b", "x", 1.0, 2.0), ("b", "x", 2.0, 3.0)] + [("c", "x", 1.0, float(i)) for i in range(5)]
    df = spark.createDataFrame(rows, "profile string, split string, p double, y double")
    got = {r.profile: r.spearman for r in stats.spearman(df, "p", "y").collect()}
    a = pd.DataFrame(rows[:5], columns=["g", "s", "p", "y"])
    assert got["a"] == pytest.approx(a["p"].rank().corr(a["y"].rank()))
    assert got["b"] is None and got["c"] is None


@pytest.mark.parametrize("errors", [[0.1, 0.2, 0.2, 1.0, -3.0, 2.5], [2.0, 2.0]])
def test_error_histogram_equals_numpy(spark, errors):
    df = spark.createDataFrame([("a", "x", e, 0.0) for e in errors], "profile string, split string, p double, y double")
    got = stats.error_histogram(df, "p", "y").orderBy("bin").collect()
    counts, edges = np.histogram(errors, bins=10)
    assert [r.n for r in got] == counts.tolist()
    assert np.allclose([r.bin_from for r in got], edges[:-1]) and np.allclose([r.bin_to for r in got], edges[1:])


def test_autocorrelation_and_unit_root_equal_numpy(spark):
    df = series(spark, profiles=("CA02",))
    x = df.orderBy("Date").toPandas()["NegativeNews"].to_numpy(float)
    d = x - x.mean()
    acf = {r.lag: r.acf for r in stats.autocorrelation(df, max_lag=7).collect()}
    assert acf == {k: pytest.approx((d[k:] * d[: len(d) - k]).sum() / (d * d).sum()) for k in range(8)}
    y, lag = np.diff(x), x[:-1]
    design = np.column_stack([np.ones_like(lag), lag])
    beta, residual = np.linalg.lstsq(design, y, rcond=None)[:2]
    error = np.sqrt(residual[0] / (len(y) - 2) * np.linalg.inv(design.T @ design)[1, 1])
    row = stats.dickey_fuller_t(df).first()
    assert row.t == pytest.approx(beta[1] / error) and row.stationary == (row.t < -2.86)


def test_constant_series_has_no_statistic(spark):
    df = spark.createDataFrame([("a", dt.date(2024, 1, d), 5) for d in range(1, 9)], "profile string, Date date, NegativeNews long")
    assert stats.dickey_fuller_t(df).first().t is None
    assert {r.acf for r in stats.autocorrelation(df, max_lag=2).collect()} == {None}


def test_model_learns_and_is_no_worse_than_naive(spark):
    df = frame(spark, days=200).withColumn(
        "split", F.when(F.col("Date") < F.lit("2024-06-01").cast("date"), "train").otherwise("test")
    )
    made, limits = features.scaled_windows(df)
    scored = forecast.real_units(forecast.score(made, forecast.fit_forecaster(made)), limits)
    model = {(r.profile, r.split): r.mae for r in stats.mae(scored, "DifferencialPredictions", "RealDiff").collect()}
    naive = {(r.profile, r.split): r.mae for r in stats.mae(forecast.naive_forecast(df), "prediction", "Diff").collect()}
    for key in (("CA02", "test"), ("trans_atlantic", "test")):
        assert model[key] <= naive[key]


def test_next_day_news_columns_and_alignment(spark):
    df = frame(spark)
    made = df.select("profile", "Date", F.lit(2.0).alias("DifferencialPredictions"))
    got = forecast.next_day_news(df, made).where("profile = 'trans_atlantic'").orderBy("Date").collect()
    assert got[1].NextDayNegativeNewsPredictions == got[1].NegativeNews + 2
    assert got[1].AlignedPredictions == got[0].NegativeNews + 2
    assert got[1].NextDayNewsPredAdjusted == got[0].NextDayNegativeNewsPredictions
    assert got[0].PredictionLocation == "transatlantic_route"


def test_calendar_adds_days_without_news(spark):
    from portrisk.operators.joins import date_spine, densify

    daily = spark.createDataFrame([("a", dt.date(2024, 1, 1), 3), ("a", dt.date(2024, 1, 4), 5)], "profile string, Date date, NegativeNews long")
    full = densify(date_spine(daily, daily.select("profile"), calendar=True), daily, ["profile", "Date"])
    assert [r.NegativeNews for r in full.orderBy("Date").collect()] == [3, 0, 0, 5]


def test_series_windows_are_always_keyed(spark):
    """No window may gather all series in one task."""
    df = frame(spark)
    for out in (windows.difference(df), windows.skip_first(df, 3), windows.sliding_windows(df, 7, P.FEATURES)):
        assert "SinglePartition" not in plan_of(out)
