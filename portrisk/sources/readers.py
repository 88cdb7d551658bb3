"""Headerless tab-separated feeds, plain or zipped, read with a fixed schema."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from portrisk import schemas

# lines handed to Spark at a time while one archive is unpacked
_LINES_PER_BATCH = 50_000


def read_tsv(spark: SparkSession, path, schema: T.StructType) -> DataFrame:
    """Lines of plain files, parsed as those of archives are."""
    return parse_lines(spark.read.text(path), schema)


def read_events_tsv(spark: SparkSession, path) -> DataFrame:
    return read_tsv(spark, path, schemas.EVENTS)


def read_gkg_tsv(spark: SparkSession, path) -> DataFrame:
    return read_tsv(spark, path, schemas.GKG)


def _unzip(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """First member of each archive as lines, streamed in batches."""
    for batch in batches:
        for path, content in zip(batch["path"], batch["content"]):
            with zipfile.ZipFile(io.BytesIO(content)) as archive:
                with archive.open(archive.namelist()[0]) as member:
                    lines = io.TextIOWrapper(member, encoding="utf-8", errors="replace", newline="\n")
                    while chunk := [
                        line.rstrip("\r\n") for _, line in zip(range(_LINES_PER_BATCH), lines)
                    ]:
                        yield pd.DataFrame({"path": path, "value": chunk})


def unzip_lines(archives: DataFrame) -> DataFrame:
    """(path, content) archives -> (path, value) lines; archives unpack in parallel."""
    return archives.select("path", "content").mapInPandas(_unzip, "path string, value string")


def parse_lines(lines: DataFrame, schema: T.StructType, keep: tuple[str, ...] = ()) -> DataFrame:
    """Split raw lines into typed columns.

    The feeds do not quote fields: a quotation mark is an ordinary character. Bad
    numbers, missing fields and empty ones are null. Empty lines hold no row.
    """
    filled = lines.where(F.col("value") != "")
    cells = filled.select(*keep, F.split(F.col("value"), "\t").alias("_cells"))
    columns = [F.nullif(F.get("_cells", F.lit(i)), F.lit("")).alias(f.name) for i, f in enumerate(schema.fields)]
    return coerce_types(cells.select(*keep, *columns), schema)


def read_zipped_tsv(
    spark: SparkSession, path: str, schema: T.StructType, keep_path: bool = False
) -> DataFrame:
    """Daily archives below ``path`` (a glob), one task per archive."""
    archives = spark.read.format("binaryFile").load(path)
    return parse_lines(unzip_lines(archives), schema, ("path",) if keep_path else ())


def coerce_types(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Text to the schema's types; what does not convert becomes null.

    Whole numbers may be written '12.0', so those go through a double when they
    are not plain integers; long ids never do, as a double would round them.
    """
    def typed(field: T.StructField):
        column, dtype = F.col(field.name), field.dataType
        text = F.trim(column.cast("string"))
        if isinstance(dtype, (T.IntegerType, T.LongType, T.ShortType)):
            whole = F.coalesce(
                text.try_cast("long"), text.try_cast("double").try_cast("long")
            )
            return whole.try_cast(dtype)
        if isinstance(dtype, T.StringType):
            return column.cast("string")
        return text.try_cast(dtype)

    known = {f.name: f for f in schema.fields}
    return df.select(
        *[typed(known[c]).alias(c) if c in known else F.col(c) for c in df.columns]
    )


def normalise_null_strings(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """The text 'nan' stands for a missing value: make it one."""
    chosen = columns or [c for c, t in df.dtypes if t == "string"]
    return df.withColumns({c: F.nullif(F.trim(F.col(c)), F.lit("nan")) for c in chosen})


def stamp_lineage(df: DataFrame, date) -> DataFrame:
    """Date of extraction and of the last change, typed; ``date`` may be a column."""
    day = (F.lit(date) if isinstance(date, str) else date).cast("date")
    return df.withColumns({"extraction_date": day, "last_modified": day})
