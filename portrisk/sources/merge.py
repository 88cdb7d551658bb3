"""Upserts and idempotent appends on Parquet tables.

``upsert`` and ``insert_only_merge`` are plain DataFrame functions. The
``*_into`` functions apply them to a stored table that is partitioned by day:
only the days the source touches are read and replaced.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from portrisk.sources.raw import spread_by


def _any_null(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])


def _renamed(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.withColumnsRenamed({k: f"_{k}" for k in keys})


def _same_key(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])


def unmatched(left: DataFrame, right: DataFrame, keys: Sequence[str], null_safe: bool) -> DataFrame:
    """Rows of ``left`` whose key is not in ``right``.

    With plain equality a null key matches nothing. Such rows bypass the join:
    they would all hash to one task.
    """
    if null_safe:
        other, same = right.select(*keys), _same_key(keys)
        if left.select(*keys).dtypes == other.dtypes:  # equal keys have equal hashes then, which sort faster
            left, other = (df.withColumn(n, F.xxhash64(*keys)) for df, n in ((left, "_hash"), (other, "__hash")))
            same = (F.col("_hash") == F.col("__hash")) & same
        return left.join(_renamed(other, keys), same, "left_anti").drop("_hash")
    known = left.where(~_any_null(keys)).join(right.where(~_any_null(keys)).select(*keys), list(keys), "left_anti")
    return known.unionByName(left.where(_any_null(keys)))


def _replaced(target: DataFrame, source: DataFrame, keys: Sequence[str], null_safe: bool) -> DataFrame:
    """Target rows that no source row updates; an error if several update one.

    The source takes part as one row per key with its number of rows, so one
    join both drops the updated rows and finds the ambiguous ones.
    """
    shown = F.concat_ws(", ", *[F.col(k).cast("string") for k in keys])
    message = F.concat(F.lit("several source rows update the target row with key "), shown)
    keep = (
        F.when(F.col("_n").isNull(), F.lit(True))
        .when(F.col("_n") > 1, F.raise_error(message).cast("boolean"))
        .otherwise(F.lit(False))
    )
    counts = source if null_safe else source.where(~_any_null(keys))
    counts = counts.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    if null_safe:
        joined = target.join(_renamed(counts, keys), _same_key(keys), "left")
        return joined.where(keep).select(*target.columns)
    # a null key matches nothing; such rows would all hash to one task of the join
    known = target.where(~_any_null(keys)).join(counts, list(keys), "left").where(keep)
    return known.select(*target.columns).unionByName(target.where(_any_null(keys)))


def upsert(
    target: DataFrame, source: DataFrame, keys: Sequence[str], null_safe: bool = False
) -> DataFrame:
    """Source rows replace target rows of equal key; the others are added.

    Several source rows for one target row are an error. Without a match in the
    target, repeated source rows are all added.
    """
    source = source.select(*target.columns)
    return _replaced(target, source, keys, null_safe).unionByName(source)


def insert_only_merge(
    target: DataFrame, source: DataFrame, keys: Sequence[str], null_safe: bool = False
) -> DataFrame:
    """Target plus the source rows whose key it does not hold yet."""
    return target.unionByName(
        unmatched(source.select(*target.columns), target, keys, null_safe)
    )


def latest_rows(
    df: DataFrame, keys: Sequence[str], by: str, null_safe: bool = False
) -> DataFrame:
    """Of each key the rows of its latest ``by``, as if deliveries had come one by one.

    Rows that share the latest ``by`` all stay, and a null key equals no other
    unless ``null_safe``.
    """
    keyed = df if null_safe else df.where(~_any_null(keys))
    last = keyed.groupBy(*keys).agg(F.max(by).alias("_last"))
    same = _same_key(keys) & (F.col(by) == F.col("_last"))
    kept = keyed.join(_renamed(last, keys), same, "left_semi")
    return kept if null_safe else kept.unionByName(df.where(_any_null(keys)))


def exists(spark: SparkSession, path: str) -> bool:
    """Is there a folder at ``path`` on whatever file system it names?"""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def _days(spark: SparkSession, path: str, days: list) -> DataFrame:
    """The stored rows of the given days; other partitions are not even listed."""
    day, values = days[0], days[1]
    chosen = F.col(day).isin([d for d in values if d is not None])
    return spark.read.parquet(path).where(chosen | F.col(day).isNull() if None in values else chosen)


def rows_of_days(spark: SparkSession, path: str, source: DataFrame, day: str) -> DataFrame:
    """Target rows of the days in the source; the list of days is bounded by the calendar."""
    return _days(spark, path, [day, [r[0] for r in source.select(day).distinct().collect()]])


def key_index(path: str) -> str:
    """Where the days of the keys of the table at ``path`` are noted."""
    return f"{path.rstrip('/')}.keys"


def _note_keys(spark: SparkSession, path: str, rows: DataFrame, keys: Sequence[str], day: str) -> None:
    """Append the (key, day) pairs that the index lacks, sorted, so that ranges of keys can be skipped."""
    index, pairs = key_index(path), rows.where(~_any_null(keys)).select(*keys, day).distinct()
    if exists(spark, index):
        pairs = unmatched(pairs, _between(spark.read.parquet(index), pairs, keys), [*keys, day], null_safe=True)
    pairs.sort(*keys).write.mode("append").parquet(index)


def _between(index: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Index rows between the least and the greatest key of the source, which the scan can skip to."""
    ends = source.agg(*(f(k).alias(f"{n}{i}") for i, k in enumerate(keys) for n, f in (("low", F.min), ("high", F.max)))).first()
    for i, k in enumerate(keys):
        index = index.where(F.col(k).between(F.lit(ends[f"low{i}"]), F.lit(ends[f"high{i}"])))
    return index


def _days_of_keys(spark: SparkSession, path: str, source: DataFrame, keys: Sequence[str], day: str) -> list:
    """Days of the source and of the stored rows with its keys; the index is made if the table has none."""
    days = {r[0] for r in source.select(day).distinct().collect()}
    if not exists(spark, key_index(path)):
        _note_keys(spark, path, spark.read.parquet(path), keys, day)
    known = source.where(~_any_null(keys)).select(*keys).distinct()
    index = _between(spark.read.parquet(key_index(path)), known, keys)
    return [day, list(days | {r[0] for r in index.join(known, list(keys), "left_semi").select(day).distinct().collect()})]


def replace_days(rows: DataFrame, path: str, day: str) -> None:
    (
        spread_by(rows, day)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(day)
        .parquet(path)
    )


def upsert_into(
    spark: SparkSession, path: str, source: DataFrame, keys: Sequence[str], day: str,
    null_safe: bool = False, moving: bool = False, replay: bool = False,
) -> None:
    """Upsert into the stored table at ``path``, rewriting only the days it touches.

    Without ``moving``, ``day`` must stay the same when a row is delivered again (an event date, not
    a date of extraction), as it tells where the earlier version is. With it, an index of the keys
    beside the table tells: keys may then come back with another day, and the old row goes. The
    index is written first; what it names too much only costs a day's rewriting.

    A dynamic partition overwrite stages the new files and swaps the days at commit, after every
    task has read the old ones; a task that is repeated before that still finds them. A ``replay`` of
    a merge that may have been applied replaces all rows of its keys and finds no update ambiguous.
    The source is read several times (days, keys, rows): freeze it if it is more than a scan.
    """
    if not exists(spark, path):
        if moving:
            _note_keys(spark, path, source, keys, day)
        replace_days(source, path, day)
        return
    if moving:
        days = _days_of_keys(spark, path, source, keys, day)
        _note_keys(spark, path, source, keys, day)
    else:
        days = [day, [r[0] for r in source.select(day).distinct().collect()]]
    target = _days(spark, path, days)
    source = source.select(*target.columns)
    emptied = _emptied(target, source, keys, days, null_safe) if moving else []
    merged = unmatched(target, source, keys, null_safe).unionByName(source) if replay else upsert(target, source, keys, null_safe)
    replace_days(merged, path, day)
    for value in emptied:
        _remove_day(spark, path, day, value)


def _emptied(target: DataFrame, source: DataFrame, keys: Sequence[str], days: list, null_safe: bool) -> list:
    """Days whose rows all move away; an overwrite leaves partitions alone that it writes nothing to."""
    day, values = days
    new = {r[0] for r in source.select(day).distinct().collect()}
    left = unmatched(target.select(*dict.fromkeys([*keys, day])), source, keys, null_safe)
    return list(set(values) - new - {r[0] for r in left.select(day).distinct().collect()})


def _remove_day(spark: SparkSession, path: str, day: str, value) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{day}={'__HIVE_DEFAULT_PARTITION__' if value is None else value}")
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def ambiguous_keys(spark: SparkSession, path: str, source: DataFrame, keys: Sequence[str], day: str, null_safe: bool = False) -> DataFrame:
    """Keys with several source rows that the stored table holds on the source's days."""
    repeated = source.groupBy(*keys).agg(F.count("*").alias("_n")).where("_n > 1").drop("_n")
    if not exists(spark, path):
        return repeated.limit(0)
    held = _renamed(rows_of_days(spark, path, source, day).select(*keys).distinct(), keys)
    same = _same_key(keys) if null_safe else reduce(lambda a, b: a & b, [F.col(k) == F.col(f"_{k}") for k in keys])
    return repeated.join(held, same, "left_semi")


_LEDGER = "stream string, batch long, state string"


def ledger(path: str) -> str:
    """Where the batches that were merged into the table at ``path`` are noted."""
    return f"{path.rstrip('/')}.batches"


def _noted(spark: SparkSession, path: str, stream: str, batch: int) -> set[str]:
    if not exists(spark, ledger(path)):
        return set()
    rows = spark.read.schema(_LEDGER).parquet(ledger(path))
    return {r.state for r in rows.where((F.col("stream") == stream) & (F.col("batch") == batch)).collect()}


def note_batch(spark: SparkSession, path: str, stream: str, batch: int, state: str) -> None:
    spark.createDataFrame([(stream, batch, state)], _LEDGER).coalesce(1).write.mode("append").parquet(ledger(path))


def merge_batch(
    spark: SparkSession, path: str, source: DataFrame, keys: Sequence[str], day: str, stream: str, batch: int,
    insert_only: bool = False, null_safe: bool = False,
) -> bool:
    """Merge a numbered batch of a stream once; False if the ledger says that it is in the table.

    Before the merge the batch is noted as started, after it as done. A batch that was started and
    not done may be in the table or not; it is merged as a replay, which leaves the same rows in both
    cases, repeated keys included. An ambiguous update is found before the batch is noted as
    started, so it stays an error however often it is tried.
    """
    noted = _noted(spark, path, stream, batch)
    if "done" in noted:
        return False
    if not noted and not insert_only:
        found = ambiguous_keys(spark, path, source, keys, day, null_safe).first()
        if found is not None:
            raise ValueError(f"several source rows update the target row with key {', '.join(map(str, found))}")
    if not noted:
        note_batch(spark, path, stream, batch, "started")
    if insert_only:
        insert_only_into(spark, path, source, keys, day, null_safe)
    else:
        upsert_into(spark, path, source, keys, day, null_safe, replay="started" in noted)
    note_batch(spark, path, stream, batch, "done")
    return True


def insert_only_into(
    spark: SparkSession, path: str, source: DataFrame, keys: Sequence[str], day: str,
    null_safe: bool = False,
) -> None:
    """Append the rows whose key the stored table does not hold yet; nothing is rewritten."""
    if not exists(spark, path):
        replace_days(source, path, day)
        return
    target = rows_of_days(spark, path, source, day)
    new = unmatched(source.select(*target.columns), target, keys, null_safe)
    spread_by(new, day).write.mode("append").partitionBy(day).parquet(path)
