"""Document fingerprints by winnowing: per window of k-gram hashes the smallest, rightmost at ties."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portrisk.llm import textkit

GRAM, WINDOW = 16, 32
_CHARS = textkit.mix(np.arange(1, 257, dtype=np.uint64))


def winnow(text: str, k: int = GRAM, w: int = WINDOW) -> np.ndarray:
    """Chosen (hash << 32 | position) of a text, by position; hashes have 32 bits.

    Any two texts that share a run of w + k - 1 code points share a chosen k-gram. A text
    with fewer than k code points is one gram; one with fewer than w grams is one window.
    """
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    if not len(code):
        return np.zeros(0, np.uint64)
    k = min(k, len(code))
    values = _CHARS[code & 255] + code.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    sums = textkit.prefix_sums(values)
    n = len(code) - k + 1
    at = np.arange(n)
    grams = textkit.range_hash(sums, at, at + k) >> np.uint64(32)
    last = np.uint64(0xFFFFFFFF)
    key = (grams << np.uint64(32)) | (last - at.astype(np.uint64))  # the rightmost of equals is smallest
    width, done = min(w, n), 1
    least = key
    while done < width:  # minima over windows of doubling width
        step = min(done, width - done)
        least = np.minimum(least[: len(least) - step], least[step:])
        done += step
    chosen = np.unique(last - (least & last)).astype(np.int64)
    return (grams[chosen] << np.uint64(32)) | chosen.astype(np.uint64)


def written(marks: np.ndarray) -> str:
    """16 hex digits for each mark: 8 of the hash, 8 of the position."""
    return marks.astype(">u8").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of the sets of hashes, positions aside; 1 for two empty ones."""
    if not len(a) and not len(b):
        return 1.0
    x, y = np.unique(a >> np.uint64(32)), np.unique(b >> np.uint64(32))
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both / (len(x) + len(y) - both)


def fingerprint(docs: DataFrame, k: int = GRAM, w: int = WINDOW) -> DataFrame:
    """doc_id, n_chars, fingerprint of every row; null is empty, an empty text has an empty one."""
    schema = "doc_id long, n_chars long, fingerprint string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            texts = [x or "" for x in rows.column(1).to_pylist()]
            yield textkit.batch(schema, rows.column(0), [len(x) for x in texts], [written(winnow(x, k, w)) for x in texts])

    return docs.select("doc_id", "text").mapInArrow(run, schema)


_RESULT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _compare(text: str, marks: np.ndarray, following: str, next_marks: np.ndarray, k: int, w: int) -> tuple:
    cut = len(text) // 4
    edited = text[: len(text) - cut] + following[:cut]
    other = winnow(edited, k, w)
    return (
        len(text), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), written(marks), written(other),
        likeness(marks, other), likeness(marks, next_marks),
    )


def _ranges(docs: DataFrame, tasks: int) -> DataFrame:
    """docs with `part`: ranges of doc_id with about as many rows each, null before all ids."""
    shares = [i / tasks for i in range(1, tasks)] or [0.5]
    bounds = docs.agg(F.percentile_approx(F.col("doc_id").cast("double"), shares, 20 * tasks)).first()[0]
    place = F.coalesce(F.col("doc_id").cast("double"), F.lit(float("-inf")))
    if not bounds:
        return docs.withColumn("part", F.lit(0))
    splits = [float("-inf"), *sorted(set(bounds)), float("inf")]
    dealt = Bucketizer(splits=splits, inputCol="place", outputCol="bucket").transform(docs.withColumn("place", place))
    return dealt.withColumn("part", F.col("bucket").cast("int")).drop("place", "bucket")


def edited_fingerprints(docs: DataFrame, k: int = GRAM, w: int = WINDOW) -> DataFrame:
    """Fingerprints of every text and of the text whose last quarter is the next document's start.

    Documents are dealt by ranges of doc_id, so all but one of each task find the next one
    beside them; the first of each range is also sent to the range before (after the last comes
    the first). So whole texts move once, and only one more for each range. Bounds and first ids
    of the ranges are read to the driver, one of each for a task.

    Null is the empty text; repeated ids follow each other by text; a single document follows
    itself; no rows give no rows. Returns doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next.
    """
    spark = docs.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = _ranges(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")), tasks)
    first = F.min(F.struct(F.col("doc_id").isNotNull(), "doc_id"))["doc_id"]
    firsts = dealt.groupBy("part").agg(first.alias("doc_id")).orderBy("part").collect()  # one for each task
    before = [(firsts[i - 1].part, row.doc_id) for i, row in enumerate(firsts)]
    wanted = F.broadcast(spark.createDataFrame(before, "to_part int, first_id long"))
    heads = dealt.join(wanted, F.col("doc_id").eqNullSafe(F.col("first_id"))).groupBy("to_part").agg(F.min("text").alias("text"))
    rows = dealt.select("part", F.lit(False).alias("guest"), "doc_id", "text").unionByName(
        heads.select(F.col("to_part").alias("part"), F.lit(True).alias("guest"), F.lit(None).cast("long").alias("doc_id"), "text")
    )
    ordered = rows.repartitionById(tasks, F.col("part")).sortWithinPartitions("part", "guest", "doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for rows in batches:
            out = []
            for guest, doc, text in zip(*(c.to_pylist() for c in rows.columns), strict=True):
                marks = winnow(text, k, w)
                if held is not None:
                    out.append((held[0], *_compare(held[1], held[2], text, marks, k, w)))
                held = None if guest else (doc, text, marks)  # a guest closes its range
                if len(out) == 256:
                    yield textkit.batch(_RESULT, *(list(x) for x in zip(*out, strict=True)))
                    out = []
            if out:
                yield textkit.batch(_RESULT, *(list(x) for x in zip(*out, strict=True)))

    return ordered.select("guest", "doc_id", "text").mapInArrow(run, _RESULT)
