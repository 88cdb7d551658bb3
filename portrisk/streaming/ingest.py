"""New raw files into a merged table, as an incremental stream.

The stream's checkpoint remembers which files are done, so late files of an old
day are picked up and a rerun does not repeat work. A ledger beside the table
notes each batch before and after its merge: a batch that is replayed after a
failure leaves the same table, also when it holds a key several times.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from portrisk.session import freeze
from portrisk.sources.merge import latest_rows, merge_batch


def incremental_ingest(
    spark: SparkSession,
    source_path: str,
    schema: T.StructType,
    table_path: str,
    checkpoint: str,
    keys: Sequence[str],
    day: str,
    insert_only: bool = False,
    transform: Callable[[DataFrame], DataFrame] | None = None,
    latest_by: str | None = None,
    max_files: int | None = None,
    timeout: int | None = None,
) -> bool:
    """Process all files that are new since the last call, then stop.

    ``schema`` names the columns of the Parquet files, the partition column
    included. ``latest_by`` names the delivery date: when one batch holds several
    deliveries of a key, the latest counts. ``max_files`` bounds one batch. Returns False if ``timeout``
    seconds passed before the stream was done.
    """
    reader = spark.readStream.schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    stream = reader.parquet(source_path)

    def write(batch: DataFrame, number: int) -> None:
        rows = latest_rows(batch, keys, latest_by) if latest_by else batch
        if transform or latest_by:
            # the merge reads its source several times
            rows = freeze(transform(rows) if transform else rows)
        merge_batch(batch.sparkSession, table_path, rows, keys, day, checkpoint, number, insert_only)

    query = (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    try:
        return query.awaitTermination(timeout) if timeout else query.awaitTermination() or True
    finally:
        query.stop()
