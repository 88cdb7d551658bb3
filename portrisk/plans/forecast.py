"""Next-day forecasts: one small model per profile, all fitted by the same aggregations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from portrisk import profiles as P
from portrisk.operators import linear
from portrisk.operators.stats import minmax_inverse
from portrisk.operators.windows import by_date, shift_prediction
from portrisk.session import freeze

# strengths of regularisation to choose from, the strongest first
RIDGES = (1e6, 100.0, 10.0, 1.0, 0.1)
SEASON = 7
OWN = ("NegativeNews", "Diff")
_VARIANT = ("scope", "prior", "strength")


def _variants() -> Column:
    """What is tried, in order of preference when errors are equal.

    Scope: the series' own earlier news and changes, or all inputs. Prior: no effect, which tends
    to the mean, or the change of the same weekday a week earlier, which tends to the naive forecast.
    """
    tried = [(scope, prior, s) for prior in ("none", "season") for scope in ("own", "all") for s in RIDGES]
    return F.array(*(F.struct(F.lit(i).alias("choice"), F.lit(a).alias("scope"), F.lit(b).alias("prior"), F.lit(c).alias("strength")) for i, (a, b, c) in enumerate(tried)))


def _fitted(systems: DataFrame) -> DataFrame:
    """Models of systems that name their scope, prior and strength."""
    width = len(P.FEATURES)
    own = F.array(*(F.lit(name in OWN) for name in P.FEATURES))
    days = (F.size("mean") / width).cast("int")
    weekday = F.when(days >= SEASON, (days - SEASON + 1) * width - 1)  # Diff closes a day's inputs
    chosen = lambda i: (F.col("scope") == "all") | F.get(own, (i % width).cast("int"))
    prior = lambda i: F.when((F.col("prior") == "season") & (i == weekday), 1.0).otherwise(0.0)
    return linear.ridge(systems, F.col("strength"), chosen, prior)


def training_moments(windows: DataFrame) -> DataFrame:
    """profile, part, width, sums: summed products of the training rows; the latest fifth of a profile is part `tail`."""
    train = windows.where(F.col("split") == "train").select("profile", "Date", "window", "target")
    return linear.moments(_parted(train), ["profile", "part"])


def _parted(train: DataFrame) -> DataFrame:
    """Training rows with their part: `head`, or `tail` for the latest fifth of the profile, one row at least.

    A profile has one row per day, so its dates are few.
    """
    dates = train.groupBy("profile").agg(F.array_sort(F.collect_list("Date")).alias("dates"))
    cut = F.get("dates", F.size("dates") - F.greatest(F.lit(1), F.floor(F.size("dates") / 5).cast("int")))
    border = dates.select("profile", cut.alias("_cut"))
    return train.join(border, "profile").withColumn("part", F.when(F.col("Date") < F.col("_cut"), "head").otherwise("tail")).drop("_cut")


def fit_forecaster(windows: DataFrame) -> DataFrame:
    """profile, intercept, coefficients: regularised linear model of the target on the window.

    Of each profile the variant counts that errs least on the latest fifth of its training rows
    when fitted on the rest; it is fitted again on all of them. Profiles with fewer than two rows
    in the first part get the mean with hardly any effect. Sums of products are Spark aggregates,
    and the systems, as large as a window, are solved by column expressions.
    """
    train = windows.where(F.col("split") == "train").select("profile", "Date", "window", "target")
    parts = freeze(training_moments(windows))
    head = linear.centred(parts.where("part = 'head'")).where("n >= 2")
    # few rows, but each is a system to solve: they are dealt to all tasks by number, not by size
    tasks = int(windows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    systems = head.withColumn("_v", F.explode(_variants())).select("*", "_v.*").repartition(tasks, "profile", "choice")
    tried = freeze(_fitted(systems).select("profile", "choice", *_VARIANT, "intercept", "coefficients"))
    tail = _parted(train).where("part = 'tail'").select("profile", "window", "target")
    error = F.abs(predicted() - F.col("target"))
    errors = tail.join(tried, "profile").groupBy("profile", "choice", *_VARIANT).agg(F.avg(error).alias("error"))
    best = errors.groupBy("profile").agg(F.min_by(F.struct(*_VARIANT), F.struct("error", "choice")).alias("best"))
    whole = linear.centred(linear.added(parts, ["profile"])).join(best, "profile", "left")
    fallback = {"scope": "all", "prior": "none", "strength": RIDGES[0]}
    named = whole.select("*", *(F.coalesce(F.col(f"best.{c}"), F.lit(v)).alias(c) for c, v in fallback.items()))
    return _fitted(named.repartition(tasks, "profile")).select("profile", "intercept", "coefficients")


def predicted() -> Column:
    """The value of a model (intercept, coefficients) for a window."""
    return F.aggregate(F.zip_with("window", "coefficients", lambda a, b: a * b), F.col("intercept"), lambda sum_, v: sum_ + v)


def score(windows: DataFrame, models: DataFrame) -> DataFrame:
    """Scaled prediction of every window by the model of its profile."""
    return (
        windows.join(models, "profile")
        .withColumn("prediction", predicted())
        .drop("intercept", "coefficients")
    )


def naive_forecast(frame: DataFrame, season: int = SEASON) -> DataFrame:
    """Seasonal baseline: the change of the same weekday a week earlier.

    Like the windows, it does not look across the train/test border.
    """
    past = F.lag("Diff", season).over(by_date("profile", "split"))
    return frame.withColumn("prediction", past).where(F.col("prediction").isNotNull())


def real_units(scored: DataFrame, limits: DataFrame) -> DataFrame:
    """Add the prediction and the target in news per day."""
    return minmax_inverse(
        scored, limits, {"prediction": "DifferencialPredictions", "target": "RealDiff"}
    )


def next_day_news(
    frame: DataFrame, predictions: DataFrame, column: str = "DifferencialPredictions"
) -> DataFrame:
    """Predicted news next to the news of the day, per profile.

    ``NextDayNegativeNewsPredictions`` adds the predicted change to the day's own
    news. The window ends the day before, so the change belongs to this day:
    ``AlignedPredictions`` adds it to the news of the row before and estimates the
    day itself. ``NextDayNewsPredAdjusted`` moves the published figure one row on,
    to compare it with the day it was published for.
    """
    before = F.lag("NegativeNews", 1).over(by_date("profile"))
    base = frame.withColumn("_before", before)
    joined = base.join(predictions.select("profile", "Date", column), ["profile", "Date"])
    named = tag_prediction_location(
        joined.withColumns(
            {
                "NextDayNegativeNewsPredictions": F.col("NegativeNews") + F.col(column),
                "AlignedPredictions": F.col("_before") + F.col(column),
            }
        )
    )
    shifted = shift_prediction(
        named, "NextDayNegativeNewsPredictions", "NextDayNewsPredAdjusted"
    )
    return shifted.select(
        "profile",
        "Date",
        "NegativeNews",
        "NextDayNegativeNewsPredictions",
        "AlignedPredictions",
        "NextDayNewsPredAdjusted",
        "ToneNegativeScore",
        *P.DISRUPTION_COUNTS.values(),
        "PredictionLocation",
    )


def tag_prediction_location(df: DataFrame) -> DataFrame:
    """Name the predicted place: route profiles get '_route', ports their code."""
    routes = [p for p in P.PROFILES if len(P.PROFILES[p]) > 1]
    route = F.concat(F.replace(F.col("profile"), F.lit("_"), F.lit("")), F.lit("_route"))
    return df.withColumn(
        "PredictionLocation", F.when(F.col("profile").isin(*routes), route).otherwise(F.col("profile"))
    )
