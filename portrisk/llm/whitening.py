"""Embedding whitening by the weighted covariance of distinct vectors.

Equal vectors are grouped first; a group counts as often as it has rows (or once). Sums are
exact integers, the covariance is a matrix product of centred vectors, and each distinct
vector is whitened once and joined back to its rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations_with_replacement

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from portrisk.llm import textkit
from portrisk.session import freeze

SCALE, OFFSET = 1024, 100_000
COMPONENTS = 8
LARGEST = 2.0**52  # entries beyond it have no 64-bit integer
RANK = 1e-12  # eigenvalues below this share of the trace are taken as zero
_SCHEMA = "vec_id {}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"


def usable(vector: Column) -> Column:
    """The vector is there and all its entries are numbers that become a long."""
    return F.coalesce(F.forall(vector, lambda c: c.isNotNull() & (F.abs(c.cast("double")) < F.lit(LARGEST))), F.lit(False))


def integers(vector: Column) -> Column:
    return F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE).cast("long") + F.lit(OFFSET).cast("long"))


def _blocks(batches: Iterator[pa.RecordBatch], d: int, weights: str) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Each batch with its vectors as rows of a matrix and their weights."""
    for batch in batches:
        if batch.num_rows:
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
            copies = batch.column(1).to_numpy()
            yield batch, x, copies if weights == "counts" else np.ones(len(copies), np.int64)


def _sums(distinct: DataFrame, d: int, weights: str) -> tuple[int, list[int]]:
    """The total weight and the exact weighted sum of each dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(d + 1, object)
        for _, x, w in _blocks(batches, d, weights):
            fits = int(w.sum()) * max(1, int(np.abs(x).max(initial=0))) < 1 << 62
            part = w @ x if fits else w.astype(object) @ x.astype(object)
            total += np.array([*part.tolist(), int(w.sum())], object)
        yield textkit.batch("at int, total string", np.arange(d + 1), [str(t) for t in total])

    parts = distinct.select("x", "copies").mapInArrow(run, "at int, total string")
    rows = parts.groupBy("at").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()  # one row per dimension
    total = {r["at"]: int(r["total"]) for r in rows}
    return total.get(d, 0), [total.get(i, 0) for i in range(d)]


def covariance(distinct: DataFrame, n: int, sums: list[int], weights: str) -> np.ndarray:
    """Weighted covariance, divisor n, of vectors centred before they are multiplied."""
    d = len(sums)
    whole = np.array([s // n for s in sums], np.int64)
    rest = np.array([s % n / n for s in sums])
    above = np.triu_indices(d)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scatter = np.zeros((d, d))
        for _, x, w in _blocks(batches, d, weights):
            centred = (x - whole) - rest
            scatter += (centred * w[:, None]).T @ centred
        yield textkit.batch("i int, j int, v double", *above, scatter[above])

    parts = distinct.select("x", "copies").mapInArrow(run, "i int, j int, v double")
    entries = parts.groupBy("i", "j").agg(F.sum("v").alias("v")).toArrow()  # bounded by the dimension
    out = np.zeros((d, d))
    i, j, v = (entries.column(c).to_numpy() for c in "ijv")
    out[i, j] = out[j, i] = v / n
    return out


def axes(cov: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Eigenvalues, unit eigenvectors (columns, largest entry positive) and shares of the trace, by falling eigenvalue."""
    value, vector = np.linalg.eigh(cov)
    order = np.argsort(-value, kind="stable")[:most]
    trace = float(np.trace(cov))
    order = order[value[order] > RANK * trace] if trace > 0 else order[:0]
    vector = vector[:, order]
    vector = vector * np.sign(vector[np.abs(vector).argmax(axis=0), np.arange(len(order))])
    return value[order], vector, value[order] / trace if len(order) else value[order]


def _whitened(distinct: DataFrame, n: int, sums: list[int], value: np.ndarray, vector: np.ndarray) -> DataFrame:
    """x, copies, deviation (text of an exact integer) and whitened entries of every distinct vector."""
    d = len(sums)
    whole = np.array([s // n for s in sums], np.int64)
    rest = [s % n for s in sums]
    share, scale = np.array([r / n for r in rest]), vector / np.sqrt(value)
    schema = "x array<long>, copies long, deviation string, w array<double>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, x, _ in _blocks(batches, d, "counts"):
            off = x - whole
            w = (off - share) @ scale
            if d * (n * (int(np.abs(off).max(initial=0)) + 1)) ** 2 < 1 << 62:
                y = n * off - np.array(rest, np.int64)
                deviation = np.einsum("ij,ij->i", y, y)
            else:
                y = n * off.astype(object) - np.array(rest, object)
                deviation = (y * y).sum(axis=1)
            spread = pa.ListArray.from_arrays(np.arange(0, w.size + 1, w.shape[1], dtype=np.int32), pa.array(w.ravel()))
            yield textkit.batch(schema, batch.column(0).cast(pa.list_(pa.int64())), batch.column(1), [str(v) for v in deviation.tolist()], spread)

    return distinct.select("x", "copies").mapInArrow(run, schema)


def _identity_error(white: DataFrame, n: int, k: int, weights: str) -> float:
    """Largest absolute entry of the covariance of the whitened vectors minus the identity."""
    weight = F.col("copies") if weights == "counts" else F.lit(1)
    entry = [F.col("w")[i] for i in range(k)]
    means = white.agg(*(F.sum(weight * e) / n for e in entry)).first()
    pairs = list(combinations_with_replacement(range(k), 2))
    got = white.agg(*(F.sum(weight * (entry[i] - means[i]) * (entry[j] - means[j])) / n for i, j in pairs)).first()
    return max(abs(got[at] - (i == j)) for at, (i, j) in enumerate(pairs))


def whiten(vectors: DataFrame, id_column: str = "vec_id", column: str = "embedding", components: int = COMPONENTS, weights: str = "counts") -> DataFrame:
    """vec_id, component (from 1), n, deviation, whitened, explained, identity_error of every usable row.

    Entries become x = floor(1024 * c) + 100000. The fit covers every distinct x, weighted by its
    rows (`weights="counts"`) or once (`"one"`); n is the total weight and S the weighted sums.
    deviation is the sum over dimensions of (n * x - S)^2; whitened is (x - S / n) projected on the
    component's unit eigenvector, over the root of its eigenvalue.

    Rows drop out whose vector is null or holds null, non-finite or unrepresentable entries (beyond
    2^52). Vectors of unequal lengths have no common covariance: the commonest length counts, the
    greater one of two equally common, and rows of other lengths drop out. Components without
    variance are not returned, so equal vectors, empty vectors and no rows give no rows. Null and
    repeated ids give their rows; further columns do not matter. Only sums and matrices of the
    dimension's size reach the driver.
    """
    if weights not in ("counts", "one"):
        raise ValueError(f"weights is 'counts' or 'one', not {weights!r}")
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_column).alias("vec_id"), F.col(column).alias("v")).where(usable(F.col("v")))
    rows = rows.select("vec_id", integers(F.col("v")).alias("x"))
    schema = _SCHEMA.format(rows.schema["vec_id"].dataType.simpleString())
    counted = freeze(rows.groupBy("x").agg(F.count("*").alias("copies")))
    lengths = counted.groupBy(F.size("x").alias("d")).agg(F.sum("copies").alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    if lengths is None or lengths["d"] == 0:
        return spark.createDataFrame([], schema)
    d = lengths["d"]
    distinct = counted.where(F.size("x") == d)
    n, sums = _sums(distinct, d, weights)
    value, vector, explained = axes(covariance(distinct, n, sums, weights), components)
    if not len(value):
        return spark.createDataFrame([], schema)
    white = freeze(_whitened(distinct, n, sums, value, vector))
    error = _identity_error(white, n, len(value), weights)
    share = F.array(*(F.lit(float(e)) for e in explained))
    back = rows.join(white.select("x", "deviation", "w"), "x").select("vec_id", "deviation", F.posexplode("w").alias("at", "whitened"))
    return back.select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(n).cast("long").alias("n"), F.col("deviation").try_cast("decimal(38,0)").alias("deviation"),
        "whitened", F.get(share, F.col("at")).alias("explained"), F.lit(error).alias("identity_error"),
    )
