"""Near-duplicate detection by min-max hashing.

Under each permutation of the shingles a set keeps its smallest and its largest hash, so a
signature needs half as many permutations as it has values, and its share of equal values
estimates the Jaccard similarity without bias. Values are cut into bands; sets that agree on a
whole band meet in its bucket. Shingles of such sets that only one of them has are in no
intersection: a set with too many has no link, and the set with the least share of them, the one
that the others are copies of, is the centre of its bucket. All sets of the bucket are checked
against it; where that leaves more than one component, the rest is compared pair by pair, unless
lone shingles rule a pair out or the estimate is far below the threshold. Every link is confirmed
on the full sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portrisk.llm import textkit
from portrisk.llm.graph import components
from portrisk.session import freeze

K, NUMERATOR, DENOMINATOR = 5, 85, 100
ROWS, BANDS = 6, 48  # values of a band (from three permutations) and bands
VALUES = ROWS * BANDS
MARGIN = 6.5  # standard deviations by which an estimate may fall short of the threshold
BLOCK = 1024  # sets of an open bucket that one task compares with as many
FILTER_BITS = 1 << 24
_FACTORS = np.random.default_rng(20240229).integers(0, 1 << 63, VALUES // 2, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SET = np.uint64(0x2545F4914F6CDD1D)


def set_names(doc: np.ndarray, value: np.ndarray, n_docs: int) -> tuple[np.ndarray, np.ndarray]:
    """Size and 64-bit name of each set of (text number, shingle); the empty set is 0."""
    sizes = np.bincount(doc, minlength=n_docs)
    names = np.zeros(n_docs, np.uint64)
    some = np.flatnonzero(sizes)
    if len(some):
        starts = np.concatenate([[0], np.cumsum(sizes)])[some]
        names[some] = textkit.mix(np.add.reduceat(textkit.mix(value + _SET), starts) + sizes[some].astype(np.uint64) * _SET)
    return sizes, names.view(np.int64)


def signatures(value: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Smallest and largest hash of each set under each permutation, side by side; sets begin at `starts`."""
    out = np.empty((len(starts), VALUES), np.uint64)
    for i, factor in enumerate(_FACTORS):
        hashed = value * factor
        out[:, 2 * i] = np.minimum.reduceat(hashed, starts)
        out[:, 2 * i + 1] = np.maximum.reduceat(hashed, starts)
    return out


def bands(signature: np.ndarray) -> np.ndarray:
    """A 64-bit key for each band of each signature."""
    mixed = textkit.mix(signature + np.arange(1, VALUES + 1, dtype=np.uint64) * _SET)
    return textkit.mix(mixed.reshape(len(signature), BANDS, ROWS).sum(axis=2, dtype=np.uint64))


def marks(signature: np.ndarray) -> np.ndarray:
    """Eight bits of each value."""
    return (signature >> np.uint64(24)).astype(np.uint8)


def least_agreement(num: int, den: int) -> float:
    """Equal marks that a linked pair has but for a chance of about 1e-10."""
    s = num / den
    return VALUES * s - MARGIN * (VALUES * s * (1 - s)) ** 0.5


def _measured(docs: DataFrame, k: int) -> DataFrame:
    """doc_id, n_shingles, id (of the set), text_id of every row; bands and marks with a set's first row in a task."""
    schema = "doc_id long, text_id long, n_shingles long, id long, bands array<long>, marks binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: set[int] = set()
        for batch in batches:
            for i, j, data, offsets in textkit.text_chunks(batch.column(2)):
                doc, value = textkit.shingles(data, offsets, k)
                sizes, names = set_names(doc, value, j - i)
                fresh = [x for x in np.flatnonzero(sizes).tolist() if not (int(names[x]) in known or known.add(int(names[x])))]
                keys, bits = [None] * (j - i), [None] * (j - i)
                if fresh:
                    own = np.zeros(j - i, bool)
                    own[fresh] = True
                    starts = np.concatenate([[0], np.cumsum(sizes[fresh])])[:-1]
                    signature = signatures(value[own[doc]], starts)
                    for x, key, mark in zip(fresh, bands(signature).view(np.int64), marks(signature), strict=True):
                        keys[x], bits[x] = key, mark.tobytes()
                yield textkit.batch(schema, batch.column(0).slice(i, j - i), batch.column(1).slice(i, j - i), sizes, names, keys, bits)

    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_id"), "text")
    return freeze(text.mapInArrow(run, schema))


def _texts(docs: DataFrame, sets: DataFrame) -> DataFrame:
    """id, text: one text for each set in `sets` (id, text_id); a filter of 2 MB spares most others the shuffle."""
    at = F.col("text_id").bitwiseAND(F.lit(FILTER_BITS - 1))
    found = sets.groupBy(F.shiftright(at, 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(text_id & 63 as int))")).alias("bits")).toArrow()
    bits = np.zeros(FILTER_BITS >> 6, np.int64)
    bits[found.column("word").to_numpy()] = found.column("bits").to_numpy()
    sent = docs.sparkSession.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            ids = batch.column(0).to_numpy()
            slot = ids & (FILTER_BITS - 1)
            hits = np.flatnonzero(sent.value[slot >> 6] >> (slot & 63) & 1)
            yield batch.take(pa.array([x for x in hits.tolist() if not (int(ids[x]) in seen or seen.add(int(ids[x])))], pa.int64()))

    passed = docs.select(F.xxhash64("text").alias("text_id"), "text").mapInArrow(run, "text_id long, text string")
    return freeze(passed.join(sets.select("id", "text_id"), "text_id").dropDuplicates(["id"]).select("id", "text"))


def _likely(pairs: DataFrame, num: int, den: int) -> DataFrame:
    """x, q of the pairs (x, q and the size, shared and marks of both) that may link."""
    least = least_agreement(num, den)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, VALUES) for c in (2, 3))
            yield batch.select([0, 1]).filter(pa.array((a == b).sum(axis=1) >= least))

    most = F.least("shared_x", "shared_q")  # of their intersection
    near = pairs.where(den * most >= num * (F.col("size_x") + F.col("size_q") - most))
    return near.select("x", "q", "marks_x", "marks_q").mapInArrow(run, "x long, q long")


def confirmed(pairs: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """a, b of the pairs (x, q, text_x, text_q) whose full sets are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                n, sets = part.num_rows, []
                for i, j, data, offsets in textkit.text_chunks(pa.concat_arrays([part.column(2), part.column(3)])):
                    doc, value = textkit.shingles(data, offsets, k)
                    sets += np.split(value, np.searchsorted(doc, np.arange(1, j - i)))
                both = np.array([len(np.intersect1d(sets[i], sets[n + i], assume_unique=True)) for i in range(n)], np.int64)
                union = np.array([len(sets[i]) + len(sets[n + i]) for i in range(n)], np.int64) - both
                yield part.select([0, 1]).rename_columns(["a", "b"]).filter(pa.array(den * both >= num * union))

    return pairs.select("x", "q", "text_x", "text_q").mapInArrow(run, "a long, b long")


def _alone(texts: DataFrame, k: int) -> DataFrame:
    """id, alone: how many shingles of each set of `texts` (id, text) no other one of them has; no row for none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, offsets in textkit.text_chunks(batch.column(1)):
                doc, value = textkit.shingles(data, offsets, k)
                yield textkit.batch("id long, shingle long", batch.column(0).to_numpy()[i:j][doc], value.view(np.int64))

    rows = texts.select("id", "text").mapInArrow(run, "id long, shingle long")
    single = rows.groupBy("shingle").agg(F.count("*").alias("n"), F.min("id").alias("id")).where("n = 1")
    return single.groupBy("id").agg(F.count("*").alias("alone"))


_OPEN = ["band", "a", "b", "side", "id", "root", "centre", "size", "shared", "marks", "bands"]


def _compared(open_rows: DataFrame, num: int, den: int) -> DataFrame:
    """x, q: pairs of an open bucket from different components that may link, each in its first common band."""
    n = open_rows.groupBy("band").agg(F.ceil(F.count("*") / BLOCK).alias("n"))
    cut = open_rows.join(n, "band").withColumn("own", F.pmod(F.xxhash64("id"), F.col("n")))
    two = F.transform(F.sequence(F.lit(0).cast("long"), F.col("n") - 1), lambda y: F.struct(F.least(y, F.col("own")).alias("a"), F.greatest(y, F.col("own")).alias("b")))
    dealt = cut.withColumn("two", F.explode(two)).withColumn("side", F.when(F.col("two.a") == F.col("two.b"), -1).when(F.col("own") == F.col("two.a"), 0).otherwise(1))
    dealt = dealt.select("band", F.col("two.a").alias("a"), F.col("two.b").alias("b"), "side", "id", "root", "centre", "size", "shared", "marks", "bands")
    tasks = int(open_rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    least = least_agreement(num, den)

    def block(table: pa.Table) -> np.ndarray:
        band = table.column("band")[0].as_py()
        side, ids, root, centre, size, shared = (table.column(c).to_numpy() for c in _OPEN[3:9])
        mark = np.frombuffer(b"".join(table.column("marks").to_pylist()), np.uint8).reshape(-1, VALUES)
        keys = table.column("bands").combine_chunks().flatten().to_numpy().reshape(-1, BANDS)
        before = int(np.flatnonzero(keys[0] == band)[0])
        found = [np.zeros((2, 0), np.int64)]
        for i in range(len(ids) - 1):
            k = i + 1 + np.flatnonzero((root[i + 1 :] != root[i]) & ((side[i + 1 :] != side[i]) | (side[i] < 0)))
            k = k[(ids[k] != centre[i]) & (ids[i] != centre[i])]  # those with the centre have been checked
            most = np.minimum(shared[k], shared[i])  # of their intersection
            k = k[den * most >= num * (size[k] + size[i] - most)]
            k = k[(mark[k] == mark[i]).sum(axis=1) >= least]
            k = k[~(keys[k, :before] == keys[i, :before]).any(axis=1)]
            found.append(np.stack([np.full(len(k), ids[i]), ids[k]]))
        return np.concatenate(found, axis=1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if held is None else pa.concat_tables([held, table])
            keys = np.stack([table.column(c).to_numpy() for c in _OPEN[:3]])
            edges = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1).tolist()]
            for i, j in zip(edges[:-1], edges[1:], strict=True):
                pairs = block(table.slice(i, j - i))
                yield textkit.batch("x long, q long", pairs.max(axis=0), pairs.min(axis=0))
            held = table.slice(edges[-1]) if table.num_rows else None
        if held is not None and held.num_rows:
            pairs = block(held)
            yield textkit.batch("x long, q long", pairs.max(axis=0), pairs.min(axis=0))

    return dealt.repartition(tasks, "band", "a", "b").sortWithinPartitions("band", "a", "b").mapInArrow(run, "x long, q long")


def near_duplicates(docs: DataFrame, k: int = K, num: int = NUMERATOR, den: int = DENOMINATOR) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row of `docs` (doc_id, text).

    Documents link when den * intersection >= num * union of their distinct k-word shingles (ASCII
    capitals lowered; fewer words than k: the whole sequence). component_id is the smallest doc_id
    reachable by links; kept marks the document that bears it. A pair at the threshold of 0.85 shares
    none of the 48 bands with a chance of (1 - 0.85^6)^48 < 1e-9, and its estimate falls below the margin
    with one of about 1e-10; nothing else can lose a link, and no pair is linked without its full sets.

    Null, empty and blank texts have no shingles and are their own component (of the rows under
    their doc_id); equal sets link; rows without an id take part, have the component of the others
    and are kept if no row of it has an id; rows repeated under one id give one row each; no rows
    give no rows; further columns do not matter. Sets are told apart by 64 bits. At thresholds below
    0.8 the chance of a loss grows; use more bands there.
    """
    docs = docs.select("doc_id", "text")
    measured = _measured(docs, k)
    sets = freeze(measured.where("n_shingles > 0").groupBy("id").agg(F.min("doc_id").alias("low_doc"), F.min("text_id").alias("text_id"), F.max("n_shingles").alias("size")))
    first = measured.where("bands is not null").select("id", "n_shingles", "bands", "marks").dropDuplicates(["id"])
    rows = first.select(F.explode("bands").alias("band"), "id")
    shared = rows.groupBy("band").agg(F.min("id").alias("low"), F.max("id").alias("high")).where("low < high").select("band")
    members = freeze(rows.join(shared, "band"))
    met = members.select("id").distinct()
    texts = _texts(docs, sets.join(met, "id", "left_semi"))
    # what a set shares with others bounds its intersections
    near = first.join(met, "id", "left_semi").join(_alone(texts, k), "id", "left").withColumn("shared", F.col("n_shingles") - F.coalesce("alone", F.lit(0)))
    near = freeze(near.where(den * F.col("shared") >= num * F.col("n_shingles")).select("id", F.col("n_shingles").alias("size"), "shared", "marks", "bands"))
    rows = members.join(near.select("id", (F.col("shared") / F.col("size")).alias("share")), "id")
    centres = rows.groupBy("band").agg(F.max_by("id", F.struct("share", "id")).alias("centre"), F.count("*").alias("n")).where("n > 1").select("band", "centre")
    rows = freeze(rows.drop("share").join(centres, "band"))

    def side(name: str) -> DataFrame:
        return near.select(F.col("id").alias(name), *(F.col(c).alias(f"{c}_{name}") for c in ("size", "shared", "marks")))

    def check(pairs: DataFrame) -> DataFrame:
        x, q = texts.select(F.col("id").alias("x"), F.col("text").alias("text_x")), texts.select(F.col("id").alias("q"), F.col("text").alias("text_q"))
        return freeze(confirmed(pairs.join(x, "x").join(q, "q"), k, num, den))

    star = rows.where("id != centre").select(F.col("id").alias("x"), F.col("centre").alias("q")).distinct()
    links = check(freeze(_likely(star.join(side("x"), "x").join(side("q"), "q"), num, den)))
    rooted = rows.join(components(links), "id", "left").withColumn("root", F.coalesce("root", "id"))
    mixed = rooted.groupBy("band").agg(F.min("root").alias("one"), F.max("root").alias("other")).where("one < other")
    pairs = freeze(_compared(rooted.join(mixed.select("band"), "band").join(near, "id"), num, den).distinct())
    roots = freeze(components(links.unionByName(check(pairs))))

    by_root = sets.join(roots, "id", "left").select("id", "low_doc", F.coalesce("root", "id").alias("root"))
    least_of = by_root.groupBy("root").agg(F.min("low_doc").alias("component_id"))
    named = by_root.join(least_of, "root").select("id", "component_id")
    out = measured.select("doc_id", "n_shingles", "id").join(named, "id", "left")
    out = out.withColumn("component_id", F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id")))
    return out.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
