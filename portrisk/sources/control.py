"""Control rows: up to which day each feed has been processed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from portrisk import schemas
from portrisk.session import freeze
from portrisk.sources.merge import exists, upsert


def next_date_to_process(control: DataFrame, name: str | None = None) -> DataFrame:
    """The day after the last processed one, for one pipeline or for all.

    No row means the control table was not initialised for that pipeline.
    """
    if name is not None:
        control = control.where(F.col("TABLE_NAME") == name)
    return control.groupBy("TABLE_NAME").agg(
        F.date_add(F.max("LAST_UPDATE_DATE"), 1).alias("next_date_to_process")
    )


def advance_control(control: DataFrame, name: str, date: str, modified=None) -> DataFrame:
    """Control rows with ``name`` set to the day that was processed.

    The date never moves back, so a repeated old day does not reopen later ones.
    """
    now = F.current_timestamp() if modified is None else F.lit(modified).cast("timestamp")
    day = F.lit(date).cast("date")
    row = control.sparkSession.range(1).select(
        F.lit(name).alias("TABLE_NAME"), day.alias("LAST_UPDATE_DATE"), now.alias("LAST_MODIFIED")
    )
    reached = control.where(
        (F.col("TABLE_NAME") == name) & (F.col("LAST_UPDATE_DATE") > day)
    ).select("TABLE_NAME")
    return upsert(control, row.join(reached, "TABLE_NAME", "left_anti"), ["TABLE_NAME"])


def empty_control(spark) -> DataFrame:
    return spark.createDataFrame([], schemas.CONTROL)


def stored_control(spark: SparkSession, path: str) -> DataFrame:
    """The stored control rows; none if the table is not there."""
    return spark.read.schema(schemas.CONTROL).parquet(path) if exists(spark, path) else empty_control(spark)


def store_control(spark: SparkSession, path: str, name: str, date: str, modified=None) -> None:
    """Advance the stored row of a pipeline, or initialise it.

    Each pipeline has a partition of its own, so pipelines do not write over each other, and the
    new row is computed before the old one is replaced.
    """
    rows = advance_control(stored_control(spark, path), name, date, modified)
    own = freeze(rows.where(F.col("TABLE_NAME") == name))
    own.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("TABLE_NAME").parquet(path)
