"""Array kernels over batches of texts, shared by the operators that run in Arrow batches.

A batch is handled as one byte array plus the bounds of each text, in chunks of a few MB,
so memory follows the chunk and never the partition; one text is never cut.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession

CHUNK_BYTES = 2 << 20
BATCH_ROWS = 1000
pa.set_memory_pool(pa.system_memory_pool())  # freed buffers go back to the system, not to a pool in each worker
_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256)
_LOWER[65:91] += 32


def short_batches(spark: SparkSession) -> None:
    """Whole texts travel in batches of BATCH_ROWS unless the session sets another number."""
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit reaches every output bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


# one 64-bit value per byte, so that sums of powers do not meet on small alphabets
BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
LOWER_VALUES = BYTE_VALUES[_LOWER]
_powers = np.ones(1, np.uint64)
_inverses = np.ones(1, np.uint64)


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers, _inverses
    if len(_powers) < n:
        size = max(n, CHUNK_BYTES + 1)
        for base, name in ((_BASE, "_powers"), (_INVERSE, "_inverses")):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            globals()[name] = np.cumprod(steps, dtype=np.uint64)
    return _powers, _inverses


def prefix_sums(values: np.ndarray) -> np.ndarray:
    """Sums of value * base^position; range_hash() reads the hash of any range from them."""
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * _tables(len(values) + 1)[0][: len(values)], out=sums[1:])
    return sums


def range_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return mix((sums[ends] - sums[starts]) * _tables(len(sums))[1][starts])


def byte_column(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and the n + 1 offsets of its texts; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("") if column.null_count else column
    large = column.cast(pa.large_string())
    offsets = np.frombuffer(large.buffers()[1], np.int64)[large.offset : large.offset + len(large) + 1]
    data = large.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    if not len(large):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about `limit` bytes together; a longer text stands alone."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def text_chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first, last, bytes, offsets from 0) for each chunk of a column."""
    data, offsets = byte_column(column)
    for i, j in chunks(offsets, limit):
        yield i, j, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]


def words(data: np.ndarray, offsets: np.ndarray, space: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of each maximal run of bytes that `space` does not mark."""
    n = len(data)
    if not n:
        return (np.zeros(0, np.int64),) * 3
    solid = ~space[data]
    before = np.zeros(n, bool)
    before[1:] = solid[:-1]
    first = offsets[:-1]
    before[first[first < n]] = False
    after = np.zeros(n, bool)
    after[:-1] = solid[1:]
    last = offsets[1:] - 1
    after[last[last >= 0]] = False
    starts = np.flatnonzero(solid & ~before)
    ends = np.flatnonzero(solid & ~after) + 1
    return starts, ends, np.searchsorted(offsets[1:], starts, side="right")


def shingles(data: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(text number, hash) of the distinct k-word shingles of each text, sorted by both.

    ASCII capitals are lowered; white space between words does not count. A text
    with fewer than k words has its whole sequence as one shingle, one without words none.
    """
    starts, ends, doc = words(data, offsets)
    n = len(offsets) - 1
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    word = range_hash(prefix_sums(LOWER_VALUES[data]), starts, ends)
    counts = np.bincount(doc, minlength=n)
    weights = [np.uint64(pow(_BASE, i + 2, 1 << 64)) for i in range(k)]
    m = len(word) - k + 1
    parts = [(np.zeros(0, np.int64), np.zeros(0, np.uint64))]
    if m > 0:
        whole = doc[:m] == doc[k - 1 :]
        total = np.zeros(m, np.uint64)
        for i in range(k):
            total += word[i : i + m] * weights[i]
        parts.append((doc[:m][whole], mix(total[whole])))
    short = np.flatnonzero((counts > 0) & (counts < k))
    if len(short):
        first = np.concatenate([[0], np.cumsum(counts)])[short]
        total = np.full(len(short), 1, np.uint64)
        for i in range(k - 1):
            there = counts[short] > i
            total[there] += word[first[there] + i] * weights[i]
        parts.append((short, mix(total ^ np.uint64(0x5851F42D4C957F2D))))
    doc, value = (np.concatenate(x) for x in zip(*parts, strict=True))
    if len(short):
        order = np.argsort(doc, kind="stable")
        doc, value = doc[order], value[order]
    cuts = np.flatnonzero(doc[1:] != doc[:-1]) + 1
    for i, j in zip([0, *cuts.tolist()], [*cuts.tolist(), len(doc)], strict=True):
        value[i:j].sort()
    fresh = np.ones(len(doc), bool)
    fresh[1:] = (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])
    return doc[fresh], value[fresh]


def columns(schema: str) -> pa.Schema:
    """An Arrow schema from "name type, ..." with the types the operators return."""
    kinds = {
        "long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(), "binary": pa.binary(),
        "boolean": pa.bool_(), "array<long>": pa.list_(pa.int64()), "array<double>": pa.list_(pa.float64()),
    }
    return pa.schema([(x.split()[0], kinds[x.split(None, 1)[1].strip()]) for x in schema.split(",")])


def batch(schema: str, *values) -> pa.RecordBatch:
    fields = columns(schema)
    return pa.RecordBatch.from_arrays(
        [v if isinstance(v, pa.Array) else pa.array(v, f.type) for v, f in zip(values, fields, strict=True)], schema=fields
    )
