"""Statistics of daily series, one result per series, all series in one job."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from portrisk import profiles as P
from portrisk.operators.windows import by_date

# fixed value: asymptotic 5 % point of the unit-root t statistic with a constant
DF_CRITICAL_5 = -2.86


def split_train_test(df: DataFrame, date: str = P.SPLIT_DATE) -> DataFrame:
    """Mark rows before ``date`` as train and the others as test."""
    is_train = F.col("Date") < F.lit(date).cast("date")
    return df.withColumn("split", F.when(is_train, "train").otherwise("test"))


def winsorize(
    df: DataFrame,
    column: str = "Diff",
    low: float = P.WINSOR_LOW,
    high: float = P.WINSOR_HIGH,
    keys: Sequence[str] = ("profile",),
    fit_on: str | None = None,
    approximate: bool = False,
) -> DataFrame:
    """Clamp a column to two of its quantiles, per series.

    Quantiles come from all rows of the series, or only from those of the split
    ``fit_on``. Exact quantiles buffer the series, which has one value per day;
    ``approximate`` keeps a sketch instead, for series without such a bound.
    """
    value = F.col(column) if fit_on is None else F.when(F.col("split") == fit_on, F.col(column))
    points = F.array(F.lit(low), F.lit(high))
    if approximate:
        quantiles = F.percentile_approx(value, [low, high], 10_000)
    else:
        quantiles = F.percentile(value, points)
    clamped = F.greatest(F.get("_q", F.lit(0)), F.least(F.get("_q", F.lit(1)), F.col(column)))
    return (
        df.withColumn("_q", quantiles.over(Window.partitionBy(*keys)))
        .withColumn(column, F.when(F.col(column).isNotNull(), clamped))
        .drop("_q")
    )


def minmax_fit(
    df: DataFrame, columns: Sequence[str], keys: Sequence[str] = ("profile",), split: str | None = "train"
) -> DataFrame:
    """Lowest value and range of each column per series; a constant gets range 1."""
    rows = df if split is None else df.where(F.col("split") == split)
    limits = rows.groupBy(*keys).agg(
        *[F.min(c).cast("double").alias(f"{c}_min") for c in columns],
        *[F.max(c).cast("double").alias(f"{c}_max") for c in columns],
    )
    def spread(c):
        width = F.col(f"{c}_max") - F.col(f"{c}_min")
        return F.when(width == 0, F.lit(1.0)).otherwise(width).alias(f"{c}_range")

    return limits.select(
        *keys, *[F.col(f"{c}_min") for c in columns], *[spread(c) for c in columns]
    )


def minmax_transform(
    df: DataFrame, fitted: DataFrame, columns: Sequence[str], keys: Sequence[str] = ("profile",)
) -> DataFrame:
    """Scale with the fitted limits; values outside the training range leave [0, 1]."""
    scaled = {c: (F.col(c) - F.col(f"{c}_min")) / F.col(f"{c}_range") for c in columns}
    helpers = [f"{c}_{part}" for c in columns for part in ("min", "range")]
    return df.join(fitted.select(*keys, *helpers), list(keys)).withColumns(scaled).drop(*helpers)


def minmax_inverse(
    df: DataFrame,
    fitted: DataFrame,
    columns: Mapping[str, str],
    source: str = "Diff",
    keys: Sequence[str] = ("profile",),
) -> DataFrame:
    """Undo the scaling with the limits fitted on ``source``: {scaled: result} columns."""
    low, width = F.col(f"{source}_min"), F.col(f"{source}_range")
    limits = fitted.select(*keys, low, width)
    return (
        df.join(limits, list(keys))
        .withColumns({name: F.col(c) * width + low for c, name in columns.items()})
        .drop(f"{source}_min", f"{source}_range")
    )


def mae(
    df: DataFrame, predicted: str, actual: str, keys: Sequence[str] = ("profile", "split")
) -> DataFrame:
    return df.groupBy(*keys).agg(F.avg(F.abs(F.col(predicted) - F.col(actual))).alias("mae"))


def spearman(
    df: DataFrame, x: str, y: str, keys: Sequence[str] = ("profile", "split")
) -> DataFrame:
    """Rank correlation with average ranks for ties; null below 3 rows or if constant."""
    def average_rank(column):
        ordered = Window.partitionBy(*keys).orderBy(column)
        ties = Window.partitionBy(*keys, column)
        return F.rank().over(ordered) + (F.count(F.lit(1)).over(ties) - 1) / 2

    ranks = (
        df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
        .withColumn("_rx", average_rank(x))
        .withColumn("_ry", average_rank(y))
    )
    spread = F.stddev_pop("_rx") * F.stddev_pop("_ry")
    rho = F.when(
        F.count(F.lit(1)) >= 3, F.try_divide(F.covar_pop("_rx", "_ry"), spread)
    )
    return ranks.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), rho.alias("spearman"))


def error_histogram(
    df: DataFrame, predicted: str, actual: str, bins: int = 10, keys: Sequence[str] = ("profile", "split")
) -> DataFrame:
    """Counts of prediction errors in equal bins; the last bin includes its upper edge.

    If all errors are equal the range is one unit around them. Empty bins count 0.
    """
    series = Window.partitionBy(*keys)
    errors = (
        df.select(*keys, (F.col(predicted) - F.col(actual)).alias("_e"))
        .where(F.col("_e").isNotNull())
        .withColumn("_lo", F.min("_e").over(series))
        .withColumn("_hi", F.max("_e").over(series))
    )
    flat = F.col("_lo") == F.col("_hi")
    low = F.when(flat, F.col("_lo") - 0.5).otherwise(F.col("_lo"))
    high = F.when(flat, F.col("_hi") + 0.5).otherwise(F.col("_hi"))
    errors = errors.withColumns({"_lo": low, "_hi": high})
    slot = F.floor((F.col("_e") - F.col("_lo")) / (F.col("_hi") - F.col("_lo")) * bins)
    slot = F.least(slot, F.lit(bins - 1))
    counted = errors.withColumn("_b", slot).groupBy(*keys).agg(
        F.first("_lo").alias("_lo"),
        F.first("_hi").alias("_hi"),
        F.array(*[F.count_if(F.col("_b") == i) for i in range(bins)]).alias("_counts"),
    )
    step = (F.col("_hi") - F.col("_lo")) / bins
    return counted.select(*keys, "_lo", "_hi", F.posexplode("_counts").alias("_i", "n")).select(
        *keys,
        (F.col("_i") + 1).alias("bin"),
        (F.col("_lo") + F.col("_i") * step).alias("bin_from"),
        (F.col("_lo") + (F.col("_i") + 1) * step).alias("bin_to"),
        "n",
    )


def autocorrelation(
    df: DataFrame, column: str = "NegativeNews", max_lag: int = 10, keys: Sequence[str] = ("profile",)
) -> DataFrame:
    """Autocorrelation of a series for lags 0..max_lag; null if it is constant."""
    centred = df.withColumn(
        "_d", F.col(column) - F.avg(column).over(Window.partitionBy(*keys))
    )
    order = by_date(*keys)
    products = centred.select(
        *keys,
        F.array(
            *[
                F.col("_d") * (F.lag("_d", k).over(order) if k else F.col("_d"))
                for k in range(max_lag + 1)
            ]
        ).alias("_p"),
    )
    sums = products.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"),
        F.array(*[F.sum(F.col("_p")[k]) for k in range(max_lag + 1)]).alias("_s"),
    )
    return (
        sums.select(*keys, "_n", F.col("_s")[0].alias("_v"), F.posexplode("_s").alias("lag", "_c"))
        .where(F.col("lag") < F.col("_n"))
        .select(*keys, "lag", F.try_divide("_c", "_v").alias("acf"))
    )


def dickey_fuller_t(
    df: DataFrame, column: str = "NegativeNews", keys: Sequence[str] = ("profile",)
) -> DataFrame:
    """t statistic of the level in a regression of the change on the previous level.

    ``stationary`` says whether it lies below the 5 % point. Null below 4 pairs.
    """
    order = by_date(*keys)
    pairs = df.withColumn("_x", F.lag(column, 1).over(order).cast("double")).withColumn(
        "_y", F.col(column) - F.col("_x")
    )
    parts = pairs.where(F.col("_x").isNotNull() & F.col("_y").isNotNull()).groupBy(*keys).agg(
        F.regr_count("_y", "_x").alias("n"),
        F.regr_slope("_y", "_x").alias("slope"),
        F.regr_sxx("_y", "_x").alias("_sxx"),
        F.regr_syy("_y", "_x").alias("_syy"),
    )
    residual = F.greatest(F.col("_syy") - F.col("slope") * F.col("slope") * F.col("_sxx"), F.lit(0.0))
    error = F.sqrt(F.try_divide(F.try_divide(residual, F.col("n") - 2), F.col("_sxx")))
    t = F.when(F.col("n") >= 4, F.try_divide(F.col("slope"), error))
    return parts.select(
        *keys, "n", "slope", t.alias("t"), (t < DF_CRITICAL_5).alias("stationary")
    )
