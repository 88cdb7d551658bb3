"""Daily series: features, statistics, windows and forecasts."""

from __future__ import annotations

from pyspark.sql import functions as F

from portrisk import fixtures as X
from portrisk import profiles as P
from portrisk.operators import aggregates, joins, linear, stats, windows
from portrisk.plans import features, forecast
from portrisk.registry.base import SPLIT, _COUNT_NAMES, query, rounded
from portrisk.session import freeze

_FLOATS = ("ToneNegativeScore", "Polarity", "Diff")
_FRAME_SQL = (
    'select profile, d as "Date", split, "NegativeNews", round("ToneNegativeScore", 6) as "ToneNegativeScore", '
    f'round("Polarity", 6) as "Polarity", "MaxToneNeg", "MinToneNeg", {_COUNT_NAMES}, round("Diff", 6) as "Diff" from '
)


def _daily(spark, sf):
    news = features.feature_news(X.gkg(spark, sf))
    return aggregates.daily_features(news, joins.route_members(spark))


def _frame(spark, sf, **options):
    news = features.feature_news(X.gkg(spark, sf))
    return features.feature_frame(news, joins.route_members(spark), SPLIT, **options)


def _changes(spark, sf):
    return windows.difference(_daily(spark, sf)).where(F.col("Diff").isNotNull())


@query(
    "g09_winsorize",
    'select profile, d as "Date", round("Diff", 6) as "Diff" from frame',
    ("frame",),
)
def _(spark, sf):
    return rounded(stats.winsorize(_changes(spark, sf)), "Diff").select("profile", "Date", "Diff")


@query(
    "g09_winsorize_train",
    'select c.profile, c.d as "Date", round(greatest(q.lo, least(q.hi, c.raw_diff)), 6) as "Diff" from changed c join '
    "(select profile, quantile_cont(raw_diff, 0.02) as lo, quantile_cont(raw_diff, 0.99) as hi from changed "
    f"where d < date '{SPLIT}' group by 1) q using (profile)",
    ("changed",),
)
def _(spark, sf):
    split = stats.split_train_test(_changes(spark, sf), SPLIT)
    return rounded(stats.winsorize(split, fit_on="train"), "Diff").select("profile", "Date", "Diff")


@query(
    "g10_minmax_fit",
    "select profile, " + ", ".join(f'round("{c}_min", 6) as "{c}_min", round("{c}_range", 6) as "{c}_range"' for c in P.FEATURES) + " from limits",
    ("limits",),
)
def _(spark, sf):
    limits = stats.minmax_fit(_frame(spark, sf), P.FEATURES)
    return rounded(limits, *[c for c in limits.columns if c != "profile"])


@query(
    "g10_minmax_transform",
    'select profile, d as "Date", ' + ", ".join(f'round("{c}", 6) as "{c}"' for c in P.FEATURES) + " from scaled",
    ("scaled",),
)
def _(spark, sf):
    frame = _frame(spark, sf)
    scaled = stats.minmax_transform(frame, stats.minmax_fit(frame, P.FEATURES), P.FEATURES)
    return rounded(scaled, *P.FEATURES).drop("split")


@query(
    "g10_minmax_inverse",
    'select profile, d as "Date", round("Diff", 6) as "Diff" from frame join limits using (profile)',
    ("frame", "limits"),
)
def _(spark, sf):
    """Scaling and back gives the series again."""
    frame = _frame(spark, sf)
    limits = stats.minmax_fit(frame, ["Diff"])
    scaled = stats.minmax_transform(frame.select("profile", "Date", "Diff"), limits, ["Diff"])
    return rounded(stats.minmax_inverse(scaled, limits, {"Diff": "Diff"}), "Diff")


def _naive(spark, sf):
    return forecast.naive_forecast(_frame(spark, sf))


@query(
    "g11_mae",
    'select profile, split, round(avg(abs(prediction - "Diff")), 6) as mae from naive group by 1, 2',
    ("naive",),
)
def _(spark, sf):
    return rounded(stats.mae(_naive(spark, sf), "prediction", "Diff"), "mae")


_AVERAGE_RANK = (
    "rank() over (partition by profile, split order by {0}) + (count(*) over (partition by profile, split, {0}) - 1) / 2"
)


@query(
    "g12_spearman",
    "select profile, split, count(*) as n, case when count(*) >= 3 and stddev_pop(rx) * stddev_pop(ry) > 0 then "
    "round(covar_pop(rx, ry) / (stddev_pop(rx) * stddev_pop(ry)), 6) end as spearman from (select *, "
    f"{_AVERAGE_RANK.format('prediction')} as rx, {_AVERAGE_RANK.format('Diff')} as ry from naive) group by 1, 2",
    ("naive",),
)
def _(spark, sf):
    return rounded(stats.spearman(_naive(spark, sf), "prediction", "Diff"), "spearman")


@query(
    "g13_error_histogram",
    "with e as (select profile, split, prediction - \"Diff\" as e from naive), r as (select profile, split, "
    "case when min(e) = max(e) then min(e) - 0.5 else min(e) end as lo, "
    "case when min(e) = max(e) then max(e) + 0.5 else max(e) end as hi from e group by 1, 2) "
    "select r.profile, r.split, b.i::int as bin, round(lo + (b.i - 1) * ((hi - lo) / 10), 6) as bin_from, "
    "round(lo + b.i * ((hi - lo) / 10), 6) as bin_to, (select count(*) from e where e.profile = r.profile and e.split = r.split "
    "and least(floor((e.e - r.lo) / (r.hi - r.lo) * 10), 9) = b.i - 1) as n from r cross join (select unnest(range(1, 11)) as i) b",
    ("naive",),
)
def _(spark, sf):
    table = stats.error_histogram(_naive(spark, sf), "prediction", "Diff")
    return rounded(table, "bin_from", "bin_to")


@query(
    "g14_autocorrelation",
    "with c as (select profile, row_number() over (partition by profile order by d) as i, \"NegativeNews\" - avg(\"NegativeNews\") "
    "over (partition by profile) as x from daily), v as (select profile, sum(x * x) as v, count(*) as n from c group by 1) "
    "select v.profile, k.lag::int as lag, case when v.v <> 0 then round((select sum(a.x * b.x) from c a join c b on a.profile = b.profile and "
    "a.i = b.i + k.lag where a.profile = v.profile) / v.v, 6) end as acf from v cross join (select unnest(range(0, 11)) as lag) k where k.lag < v.n",
    ("daily",),
)
def _(spark, sf):
    return rounded(stats.autocorrelation(_daily(spark, sf), "NegativeNews", 10), "acf")


def _unit_root_sql(column, source):
    return (
        "with p as (select profile, x, y - x as y from (select profile, "
        f"lag({column}) over (partition by profile order by d)::double as x, {column} as y from {source}) where x is not null), "
        "s as (select profile, regr_count(y, x)::bigint as n, regr_slope(y, x) as slope, regr_sxx(y, x) as sxx, regr_syy(y, x) as syy from p group by 1), "
        "t as (select *, sqrt(greatest(syy - slope * slope * sxx, 0) / nullif(n - 2, 0) / nullif(sxx, 0)) as se from s) "
        "select profile, n, round(slope, 6) as slope, case when n >= 4 and se > 0 then round(slope / se, 6) end as t, "
        "case when n >= 4 and se > 0 then slope / se < -2.86 end as stationary from t"
    )


@query("g15_dickey_fuller_t", _unit_root_sql('"NegativeNews"', "daily"), ("daily",))
def _(spark, sf):
    return rounded(stats.dickey_fuller_t(_daily(spark, sf)), "slope", "t")


@query("g15_dickey_fuller_t_diff", _unit_root_sql('"Diff"', "frame"), ("frame",))
def _(spark, sf):
    return rounded(stats.dickey_fuller_t(_frame(spark, sf), "Diff"), "slope", "t")


@query(
    "w05_difference",
    'select profile, d as "Date", "NegativeNews", cast("NegativeNews" - lag("NegativeNews") over (partition by profile order by d) as double) as "Diff" from daily',
    ("daily",),
)
def _(spark, sf):
    return windows.difference(_daily(spark, sf)).select("profile", "Date", "NegativeNews", "Diff")


@query(
    "w06_sliding_windows",
    "select profile, split, d as \"Date\", round(target, 6) as target, (step * 13 + f)::int as position, round(v, 6) as value from ("
    + " union all ".join(
        f'select profile, split, d, target, step, {i} as f, "{c}"::double as v from window_rows' for i, c in enumerate(P.FEATURES)
    )
    + ")",
    ("scaled", "window_rows"),
)
def _(spark, sf):
    made, _limits = features.scaled_windows(_frame(spark, sf), lags=7)
    long = made.select("profile", "split", "Date", "target", F.posexplode("window").alias("position", "value"))
    return rounded(long, "target", "value")


@query(
    "w07_shift_prediction",
    'select profile, d as "Date", round(prediction, 6) as prediction, round(lag(prediction) over (partition by profile order by d), 6) as shifted from naive',
    ("naive",),
)
def _(spark, sf):
    shifted = windows.shift_prediction(_naive(spark, sf), "prediction", "shifted")
    return rounded(shifted, "prediction", "shifted").select("profile", "Date", "prediction", "shifted")


@query(
    "w08_skip_first",
    'select profile, d as "Date", "NegativeNews" from (select *, row_number() over (partition by profile order by d) as i from daily) where i > 7',
    ("daily",),
)
def _(spark, sf):
    return windows.skip_first(_daily(spark, sf), 7).select("profile", "Date", "NegativeNews")


@query(
    "t01_split_train_test",
    'select profile, split, count(*) as days, min(d) as first_day, max(d) as last_day from frame group by 1, 2',
    ("frame",),
)
def _(spark, sf):
    split = stats.split_train_test(_changes(spark, sf), SPLIT)
    return split.groupBy("profile", "split").agg(
        F.count(F.lit(1)).alias("days"), F.min("Date").alias("first_day"), F.max("Date").alias("last_day")
    )


@query("t02_feature_frame", f"{_FRAME_SQL} frame", ("frame",))
def _(spark, sf):
    return rounded(_frame(spark, sf), *_FLOATS)


@query(
    "t03_naive_forecast",
    'select profile, d as "Date", split, round("Diff", 6) as "Diff", round(prediction, 6) as prediction from naive',
    ("naive",),
)
def _(spark, sf):
    return rounded(_naive(spark, sf), "Diff", "prediction").select("profile", "Date", "split", "Diff", "prediction")


def _model_scores(frame):
    made, limits = features.scaled_windows(frame)
    return forecast.real_units(forecast.score(made, forecast.fit_forecaster(made)), limits)


_WINDOW_VALUES = ", ".join(f'{{pos: 1 + step * {len(P.FEATURES)} + {i}, v: "{c}"::double}}' for i, c in enumerate(P.FEATURES))
_LAST = 7 * len(P.FEATURES) + 1


@query(
    "t03_normal_equations",
    "with z as (select profile, d, x.pos as pos, x.v as v from (select profile, d, unnest([" + _WINDOW_VALUES + "]) as x from window_rows where split = 'train') "
    f"union all select profile, d, unnest([0, {_LAST}]), unnest([1.0, target]) from window_rows where split = 'train' and step = 0) "
    "select a.profile, a.pos::int as i, b.pos::int as j, round(sum(a.v * b.v) + 1e-7, 5) as value from z a join z b on a.profile = b.profile and a.d = b.d and a.pos <= b.pos group by all",
    ("window_rows",),
)
def _(spark, sf):
    """Sums of products of (1, window, target), the entries of each profile's normal equations.

    The small addend keeps exact halves, which scaled counts often are, off the border of rounding.
    """
    made, _limits = features.scaled_windows(_frame(spark, sf), 7)
    sums = linear.added(forecast.training_moments(made), ["profile"])
    return linear.entries(sums, ["profile"]).select("profile", "i", "j", F.round(F.col("value") + 1e-7, 5).alias("value"))


@query(
    "t03_fit_check",
    f"select profile, unnest(range({_LAST - 1}))::int as i, 0.0::double as residual from (select distinct profile from window_rows where split = 'train')",
    ("window_rows",),
)
def _(spark, sf):
    """What is left of the normal equations at the fitted coefficients, from the training rows themselves.

    At the minimum, the errors times each centred input sum up to strength * coefficient.
    """
    made, _limits = features.scaled_windows(_frame(spark, sf), 7)
    made = freeze(made.where("split = 'train'"))
    system = linear.centred(linear.moments(made, ["profile"]))
    models = freeze(linear.ridge(system, F.lit(1.0), lambda i: i >= 0, lambda i: F.lit(0.0)).select("profile", "mean", "intercept", "coefficients"))
    scored = made.join(models, "profile").withColumn("error", F.col("target") - forecast.predicted())
    parts = scored.select("profile", "error", F.posexplode(F.arrays_zip("window", "mean", "coefficients")).alias("i", "x"))
    left = F.sum(F.col("error") * (F.col("x.window") - F.col("x.mean"))) - F.first("x.coefficients")
    return parts.groupBy("profile", "i").agg(F.abs(F.round(left, 6)).alias("residual"))


@query("t03_fit_forecaster")
def _(spark, sf):
    made, _limits = features.scaled_windows(freeze(_frame(spark, sf)))
    models = forecast.fit_forecaster(made)
    return models.select("profile", "intercept", F.size("coefficients").alias("inputs"))


@query("t03_score")
def _(spark, sf):
    scored = _model_scores(freeze(_frame(spark, sf)))
    return scored.select("profile", "Date", "split", "DifferencialPredictions", "RealDiff")


@query("t03_model_mae")
def _(spark, sf):
    return stats.mae(_model_scores(freeze(_frame(spark, sf))), "DifferencialPredictions", "RealDiff")


@query(
    "t04_next_day_news",
    "select profile, \"Date\", \"NegativeNews\", round(nxt, 6) as \"NextDayNegativeNewsPredictions\", round(aligned, 6) as \"AlignedPredictions\", "
    "round(lag(nxt) over (partition by profile order by \"Date\"), 6) as \"NextDayNewsPredAdjusted\", "
    f"round(\"ToneNegativeScore\", 6) as \"ToneNegativeScore\", {_COUNT_NAMES}, case profile when 'trans_pacific' then 'transpacific_route' "
    "when 'trans_atlantic' then 'transatlantic_route' else profile end as \"PredictionLocation\" from "
    "(select f.profile, f.d as \"Date\", f.\"NegativeNews\", f.\"NegativeNews\" + n.prediction as nxt, f.before + n.prediction as aligned, "
    "f.\"ToneNegativeScore\", " + ", ".join(f'f."{c}"' for c in P.DISRUPTION_COUNTS.values()) + " from (select *, lag(\"NegativeNews\") over (partition by profile order by d) as before from frame) f "
    "join naive n on n.profile = f.profile and n.d = f.d)",
    ("frame", "naive"),
)
def _(spark, sf):
    frame = _frame(spark, sf)
    predictions = forecast.naive_forecast(frame).withColumnRenamed("prediction", "DifferencialPredictions")
    out = forecast.next_day_news(frame, predictions)
    return rounded(
        out, "NextDayNegativeNewsPredictions", "AlignedPredictions", "NextDayNewsPredAdjusted", "ToneNegativeScore"
    )


@query("t04_next_day_news_model")
def _(spark, sf):
    frame = freeze(_frame(spark, sf))
    return forecast.next_day_news(frame, _model_scores(frame))
