"""Row numbers within groups, safe for groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from portrisk.session import freeze


def top_rows(
    df: DataFrame, by: Sequence[str], order: Sequence[Column], k: int, name: str = "rank"
) -> DataFrame:
    """The first ``k`` rows of each group.

    Each task keeps only its own first ``k`` before the shuffle (a window group
    limit), so the size of a group does not matter.
    """
    window = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn(name, F.row_number().over(window)).where(F.col(name) <= k)


def rank_rows(
    df: DataFrame, by: Sequence[str], order: Sequence[Column], name: str = "rank", parts: int | None = None
) -> DataFrame:
    """Number all rows of each group: position inside a range + rows of the group in earlier ranges.

    The row id closes the sort key, so even a group of identical rows is cut into
    even ranges (``parts`` of them, by default as many as a shuffle has). The
    sorted rows are frozen in storage when this is called, before anything is
    counted: rows and counts can then not disagree, also after a lost executor.
    """
    keys = [F.col(c).asc_nulls_first() for c in by] + [*order, F.col("_id").asc()]
    placed = (
        df.withColumn("_id", F.monotonically_increasing_id())
        .repartitionByRange(*([parts] if parts else []), *keys)
        .sortWithinPartitions(*keys)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_pos", F.monotonically_increasing_id())
    )
    frozen = freeze(placed)

    # one row per group and range partition: groups + partitions rows at most
    pieces = frozen.groupBy(*by, "_part").agg(
        F.count(F.lit(1)).alias("_rows"), F.min("_pos").alias("_first")
    )
    earlier = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = freeze(pieces.select(
        *[F.col(c).alias(f"_{c}") for c in by],
        F.col("_part").alias("__part"),
        "_first",
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"),
    ))  # a table of known size, so that rows do not move to meet a few offsets
    same_piece = F.col("_part") == F.col("__part")
    for c in by:
        same_piece = same_piece & F.col(c).eqNullSafe(F.col(f"_{c}"))
    number = (F.col("_before") + F.col("_pos") - F.col("_first") + 1).cast("int")
    return frozen.join(offsets, same_piece).select(*df.columns, number.alias(name))


def _tie_break(columns: Sequence[str]) -> list[Column]:
    """Ties are ordered by the identity of the news row, so ranks are repeatable."""
    return [F.col(c).asc_nulls_last() for c in ("CAMEOEVENTIDS", "SOURCEURLS") if c in columns]


def rank_negative(df: DataFrame, **options) -> DataFrame:
    """Rank all news of a day and place, most negative first."""
    order = [F.col("ToneNegativeScore").desc_nulls_last(), *_tie_break(df.columns)]
    return rank_rows(df, ["Date", "LocationCode"], order, "rank", **options)


def top_negative(df: DataFrame, k: int = 3) -> DataFrame:
    """The ``k`` most negative news of each day and place."""
    order = [F.col("ToneNegativeScore").desc_nulls_last(), *_tie_break(df.columns)]
    return top_rows(df, ["Date", "LocationCode"], order, k, "rank")


def top_themes(df: DataFrame, k: int | None = 3, by: Sequence[str] = ("Date",), **options) -> DataFrame:
    """News of a day by theme score; the first ``k``, or all ranked if k is None."""
    order = [F.col("Total").desc_nulls_last(), *_tie_break(df.columns)]
    if k is None:
        return rank_rows(df, list(by), order, "Rank", **options)
    return top_rows(df, list(by), order, k, "Rank")


def preview(df: DataFrame, n: int, *order: Column | str) -> DataFrame:
    """The first ``n`` rows in a stated order (no full sort)."""
    return df.orderBy(*order).limit(n)
