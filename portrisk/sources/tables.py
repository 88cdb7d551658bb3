"""Catalog tables over stored files."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from portrisk import schemas
from portrisk.sources.raw import spread_by


def create_table(
    spark: SparkSession, table: str, schema: T.StructType, path: str, partition_by: str
) -> None:
    """Create an empty external Parquet table from a schema, unless it is there."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet "
        f"PARTITIONED BY (`{partition_by}`) LOCATION '{path}'"
    )


def create_events_table(spark: SparkSession, table: str, path: str) -> None:
    """The table that the daily job fills, partitioned by the day of the event."""
    create_table(spark, table, schemas.with_lineage(schemas.EVENTS), path, "Day")


def _stored_schema(spark: SparkSession, path: str, df: DataFrame) -> T.StructType | None:
    """The schema of the rows below a path, with the types of ``df`` where names agree; None without rows."""
    try:
        found = spark.read.parquet(path).schema
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise
    return T.StructType([df.schema[f.name] if f.name in df.columns else f for f in found.fields])


def create_or_append(
    df: DataFrame, table: str, path: str, partition_by: str | None = None, mode: str = "append"
) -> None:
    """Write to a table, registering it on first use.

    The first write creates the table; later ones append, or replace all rows
    with ``mode='overwrite'``. Rows that a path holds before its table is known
    are kept: the path is registered, then appended to.
    """
    spark = df.sparkSession
    exists = spark.catalog.tableExists(table)
    if not exists and (schema := _stored_schema(spark, path, df)) is not None:
        if partition_by:
            create_table(spark, table, schema, path, partition_by)
            spark.catalog.recoverPartitions(table)
        else:
            spark.catalog.createTable(table, path=path, source="parquet", schema=schema)
        exists = True
    if partition_by:
        df = spread_by(df, partition_by)
    writer = df.write.format("parquet")
    if exists:
        columns = spark.table(table).columns
        df.select(*columns).write.mode(mode).insertInto(table, overwrite=mode == "overwrite")
        return
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.mode("overwrite").option("path", path).saveAsTable(table)
