"""Raw landing area: Parquet, one partition per day."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DAY = "dt"


def spread_by(df: DataFrame, *columns: str) -> DataFrame:
    """Gather rows of a partition value into few files, splitting large ones.

    A rebalance lets adaptive execution cut a crowded day into several tasks and
    merge quiet days, so the file count follows the data.
    """
    return df.hint("rebalance", *[F.col(c) for c in columns])


def land_raw(df: DataFrame, path: str, date=None) -> None:
    """Write rows under their day; days in ``df`` are replaced, others are kept.

    ``date`` is the day of all rows, or a column that gives each row's day.
    """
    day = (F.lit(date) if isinstance(date, str) else date).cast("date")
    (
        spread_by(df.withColumn(DAY, day), DAY)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(DAY)
        .parquet(path)
    )


def read_raw(spark: SparkSession, path: str, low: str, high: str | None = None) -> DataFrame:
    """The rows of a day, or of an inclusive range of days; other days are not opened."""
    rows = spark.read.parquet(path)
    return scan_range(rows, low, high or low, DAY)


def scan_range(table: DataFrame, low: str, high: str, column: str = "Date") -> DataFrame:
    """Inclusive date range on a typed date column (pruned if it partitions the table)."""
    return table.where(
        F.col(column).between(F.lit(low).cast("date"), F.lit(high).cast("date"))
    )


def missing_days(df: DataFrame, start: str, end: str, column: str = DAY) -> DataFrame:
    """Days of the inclusive range without a single row."""
    spark = df.sparkSession
    wanted = spark.range(1).select(
        F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))).alias(column)
    )
    return wanted.join(df.select(column).distinct(), column, "left_anti")


def backfill(
    spark: SparkSession, path: str, start: str, end: str
) -> tuple[DataFrame, DataFrame]:
    """Rows of all landed days of a range in one job, and the days that are missing."""
    rows = read_raw(spark, path, start, end)
    return rows, missing_days(rows, start, end)
