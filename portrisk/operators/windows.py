"""Windows over daily series.

All windows are keyed: a series has one row per day (and place or profile), so
the rows of one window are bounded by the calendar, never by the news volume.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from portrisk.functions.themes import fill_zero


def by_date(*keys: str) -> WindowSpec:
    return Window.partitionBy(*keys).orderBy("Date")


def growth(df: DataFrame, keys: Sequence[str] = ("Total", "LocationCode")) -> DataFrame:
    """Day-on-day growth of news and the growth of the day before; no base -> 0."""
    window = by_date(*keys)
    past = F.lag("NumberOfNews", 1).over(window)
    first = df.withColumn("NumberOfNewsPastDay", past).withColumn(
        "GrowthNumberOfNewsPastDay",
        F.try_divide(F.col("NumberOfNews") - F.col("NumberOfNewsPastDay"), F.col("NumberOfNewsPastDay")),
    )
    lagged = first.withColumn(
        "LagGrowthNumberOfNewsPastDay", F.lag("GrowthNumberOfNewsPastDay", 1).over(window)
    )
    return fill_zero(lagged)


def lag_weight(daily: DataFrame, days: int = 2) -> DataFrame:
    """Weight of the row ``days`` rows earlier at the same place; none -> 0."""
    past = F.lag("WeightedCountOfNews", days).over(by_date("LocationCode"))
    return fill_zero(daily.withColumn("LagWeightedCountNews", past))


def difference(
    df: DataFrame, column: str = "NegativeNews", keys: Sequence[str] = ("profile",), name: str = "Diff"
) -> DataFrame:
    """Change against the previous row of the series; null on the first row."""
    value = F.col(column) - F.lag(column, 1).over(by_date(*keys))
    return df.withColumn(name, value.cast("double"))


def shift_prediction(
    df: DataFrame, column: str, name: str, keys: Sequence[str] = ("profile",), rows: int = 1
) -> DataFrame:
    return df.withColumn(name, F.lag(column, rows).over(by_date(*keys)))


def skip_first(df: DataFrame, n: int | Column, keys: Sequence[str] = ("profile",)) -> DataFrame:
    """Drop the first ``n`` rows of each series."""
    limit = n if isinstance(n, Column) else F.lit(n)
    return (
        df.withColumn("_n", F.row_number().over(by_date(*keys))).where(F.col("_n") > limit).drop("_n")
    )


def sliding_windows(
    df: DataFrame,
    n: int | Mapping[str, int],
    features: Sequence[str],
    target: str = "Diff",
    keys: Sequence[str] = ("profile", "split"),
) -> DataFrame:
    """Features of the ``n`` rows before each row, oldest first, and its target.

    ``n`` is one number or one per profile. Windows do not cross from training
    into test rows, and rows with fewer than ``n`` predecessors are dropped.
    """
    order = by_date(*keys)
    if isinstance(n, int):
        widest, length = n, F.lit(n)
    else:
        widest = max(n.values())
        length = F.coalesce(*[F.when(F.col("profile") == p, F.lit(v)) for p, v in n.items()])
    row = F.array(*[F.col(c).cast("double") for c in features])
    past = F.collect_list(row).over(order.rowsBetween(-widest, -1))
    return (
        df.withColumn("_past", past)
        .withColumn("_n", F.row_number().over(order))
        .where(F.col("_n") > length)
        .withColumn("window", F.flatten(F.slice("_past", -length, length)))
        .withColumn("target", F.col(target).cast("double"))
        .drop("_n", "_past")
    )
