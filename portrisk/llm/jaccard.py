"""N-gram Jaccard join: exact links between documents by pivots and triangle-inequality windows.

Jaccard distance is a metric, but nearly all documents of a corpus are at distance 1 from any
document, so document pivots alone would leave windows that hold everything. The first pivots are
therefore single shingles: in one order of all shingles, rare ones first, a document's home is its
first shingle, and its window holds the next ones, as many as the threshold lets a partner miss.
The window is a quarter longer than that, so that linked documents share not one but several
shingles of it. A document is replicated into the region of each shingle of its window; one whose
window has too few shared shingles is linked with nothing and leaves before any text moves, and so
do, afterwards, those with too many shingles that no other one of those that met has.

Regions are then joined recursively. The pivot of a region is its document with the largest share
of shingles that others have; each document of the region is compared with it on full sets. What
has linked with the pivot is settled among itself. Of the rest, and of those whose distance to the
pivot allows a link with it, regions above a block choose the next pivot, as long as that halves
what is open. The blocks that remain are joined exactly: windows of distance and size, numbers of
equal parts of a hash partition, bounds from shared shingles, and full sets in the end.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from portrisk.llm import textkit
from portrisk.llm.graph import components
from portrisk.llm.names import private
from portrisk.session import freeze

K, NUMERATOR, DENOMINATOR = 4, 85, 100
RING = 1.5  # least ratio of the bounds of a size ring
SKETCH = 1 << 18  # counters of shingle frequency
COMMON = 4  # a counter this many times the mean holds a common shingle
BLOCK = 1024  # documents of an open region that are compared in one task
FILTER_BITS = 1 << 24
_VALUE = np.uint64(0x5DEECE66D5DEECE7)


class Reach:
    """What follows from the threshold num / den alone: rings of sizes, linked sets in one or in neighbours, and parts for each."""

    def __init__(self, num: int, den: int) -> None:
        self.num, self.den = num, den
        bounds = [1]
        while bounds[-1] < 1 << 40:
            bounds.append(int(bounds[-1] * max(RING, den / num)) + 1)
        self.bounds = np.array(bounds)
        far = np.array([self.apart(2 * (b - 1)) for b in bounds[1:]])
        self.parts = far + 1 + np.maximum(1, (far + 1) // 14)

    def apart(self, total: int) -> int:
        """The largest symmetric difference of linked sets of `total` shingles together."""
        return (self.den - self.num) * total // (self.den + self.num)

    def window(self, size):
        """How many first shingles of a set hold the first one that it shares with a partner."""
        return size + 1 + (-self.num * size) // self.den

    def common(self, size):
        """How many shared shingles the longer windows of linked sets of at least `size` shingles have."""
        return np.maximum(1, self.window(size) // 4)


def cells(doc: np.ndarray, value: np.ndarray, n_docs: int, reach: Reach, common: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text number, cell) for sets given as sorted (text number, shingle): the first shingles of each.

    The order of shingles is by whether their counter is common, then by value. A set of n
    shares at least ceil(num * n / den) with each partner, so the first shared shingle is among
    the first n + 1 - ceil(num * n / den) of both, and each one more holds one more shared one.
    """
    sizes = np.bincount(doc, minlength=n_docs)
    starts = np.concatenate([[0], np.cumsum(sizes)])[:-1]
    often = common[(value & np.uint64(SKETCH - 1)).astype(np.int64)]
    order = np.lexsort((often, doc))  # stable: values stay sorted
    doc, value = doc[order], value[order]
    chosen = np.arange(len(doc)) - starts[doc] < (reach.window(sizes) + reach.common(sizes) - 1)[doc]
    return doc[chosen], value[chosen]


def part_marks(doc: np.ndarray, value: np.ndarray, rings: np.ndarray, reach: Reach) -> list[bytes]:
    """For each set, 16 bits of what each of its parts in the given ring holds; rings below 0 have none."""
    parts = np.where(rings >= 0, reach.parts[np.maximum(rings, 0)], 0)
    base = np.concatenate([[0], np.cumsum(parts)])
    marks = np.zeros(base[-1], np.uint16)
    rows = rings[doc] >= 0
    d, v = doc[rows], value[rows]
    if len(d):
        part = ((v >> np.uint64(32)) * parts[d].astype(np.uint64) >> np.uint64(32)).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], (d[1:] != d[:-1]) | (part[1:] != part[:-1])]))
        sums = textkit.mix(np.add.reduceat(textkit.mix(v ^ _VALUE), first))
        marks[base[d[first]] + part[first]] = (sums & np.uint64(0xFFFF)).astype(np.uint16) | 1
    return [marks[a:b].tobytes() for a, b in zip(base[:-1], base[1:], strict=True)]


_OPEN = ["cell", "a", "b", "side", "id", "size", "shared", "root", "free", "distance", "own_marks", "next_marks", "regions"]


def _may_link(reach: Reach):
    """x, q: pairs of a region's block that the windows, the bounds and the equal parts leave, each in its first common region.

    Rows come sorted by block; a block may go on in the next batch.
    """
    num, den = reach.num, reach.den
    near = (den - num) / den + 1e-9

    def pairs(cell, side, ids, size, shared, root, free, distance, own, following, regions) -> list[np.ndarray]:
        ring = np.searchsorted(reach.bounds, size, side="right") - 1
        found = []
        for r in np.unique(ring):
            upper, lower = np.flatnonzero(ring == r), np.flatnonzero(ring == r - 1)
            both = np.concatenate([upper, lower])
            if len(both) < 2:
                continue
            rows = [own[i] for i in upper] + [following[i] for i in lower]
            marks = np.frombuffer(b"".join(rows), np.uint16).reshape(len(both), -1)
            for at, i in enumerate(upper):
                others = both[at + 1 :]
                most = np.minimum(shared[others], shared[i])  # of their intersection
                keep = (root[others] != root[i]) & (free[others] | free[i]) & (np.abs(distance[others] - distance[i]) <= near)
                keep &= (side[i] != side[others]) | (side[i] < 0)
                keep &= den * most >= num * (size[others] + size[i] - most)
                k = np.flatnonzero(keep)
                if len(k):
                    agree = (marks[at + 1 + k] == marks[at]).sum(axis=1)
                    k = k[agree >= marks.shape[1] - (den - num) * (size[i] + size[others[k]]) // (den + num)]
                q = [j for j in others[k].tolist() if min(regions[i] & regions[j]) == cell]
                if q:
                    found.append(np.stack([np.full(len(q), ids[i]), ids[q]]))
        return found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def close(table: pa.Table, until: int, cuts: np.ndarray) -> pa.RecordBatch:
            flat = [table.column(c).to_numpy() for c in _OPEN[3:10]]
            marks = [table.column(c).slice(0, until).to_pylist() for c in _OPEN[10:12]]
            where, region = table.column("cell").to_numpy(), table.column("regions").slice(0, until)
            found = []
            for i, j in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                if j - i > 1:
                    sets = [set(x) for x in region.slice(i, j - i).to_pylist()]
                    found += pairs(where[i], *(x[i:j] for x in flat), *(m[i:j] for m in marks), sets)
            out = np.concatenate(found, axis=1) if found else np.zeros((2, 0), np.int64)
            return textkit.batch("x long, q long", out.max(axis=0), out.min(axis=0))

        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if held is None else pa.concat_tables([held, table])
            keys = np.stack([table.column(c).to_numpy() for c in _OPEN[:3]])
            edges = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
            if len(edges):
                yield close(table, int(edges[-1]), np.concatenate([[0], edges]))
                table = table.slice(int(edges[-1]))
            held = table
        if held is not None and held.num_rows:
            yield close(held, held.num_rows, np.array([0, held.num_rows]))

    return run


def _blocks(state: DataFrame, rows: int) -> DataFrame:
    """Cut regions into blocks of about `rows` documents; a pair of blocks is one group, side tells them apart (-1: one block)."""
    n = state.groupBy("cell").agg(F.ceil(F.count("*") / rows).alias("n"))
    cut = state.join(n, "cell").withColumn("block", F.pmod(F.xxhash64("id", F.lit(5)), F.col("n")))
    pairs = F.transform(F.sequence(F.lit(0).cast("long"), F.col("n") - 1), lambda y: F.struct(F.least(y, F.col("block")).alias("a"), F.greatest(y, F.col("block")).alias("b")))
    out = cut.withColumn("pair", F.explode(pairs))
    side = F.when(F.col("pair.a") == F.col("pair.b"), -1).when(F.col("block") == F.col("pair.a"), 0).otherwise(1)
    return out.withColumns({"side": side, "a": F.col("pair.a"), "b": F.col("pair.b")}).drop("pair", "n", "block")


def set_ids(doc: np.ndarray, value: np.ndarray, n_docs: int) -> tuple[np.ndarray, np.ndarray]:
    """Size and 64-bit name of each set; the empty set is 0."""
    sizes = np.bincount(doc, minlength=n_docs)
    names = np.zeros(n_docs, np.uint64)
    some = sizes > 0
    if some.any():
        starts = np.concatenate([[0], np.cumsum(sizes)])[:-1][some]
        names[some] = textkit.mix(np.add.reduceat(textkit.mix(value ^ _VALUE), starts) ^ textkit.mix(np.bitwise_xor.reduceat(value, starts) + sizes[some].astype(np.uint64)))
    return sizes, names.view(np.int64)


def linked(pairs: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """x, q, distance, link for pairs of different sets given by x, q, text_x, text_q."""
    schema = "x long, q long, distance double, link boolean"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                texts = pa.concat_arrays([part.column(2), part.column(3)])
                n, sets = part.num_rows, []
                for i, j, data, offsets in textkit.text_chunks(texts):
                    doc, value = textkit.shingles(data, offsets, k)
                    sets += np.split(value, np.searchsorted(doc, np.arange(1, j - i)))
                both = np.array([len(np.intersect1d(sets[i], sets[n + i], assume_unique=True)) for i in range(n)], np.int64)
                union = np.array([len(sets[i]) + len(sets[n + i]) for i in range(n)], np.int64) - both
                yield textkit.batch(schema, part.column(0), part.column(1), 1 - both / np.maximum(union, 1), den * both >= num * union)

    return pairs.select("x", "q", "text_x", "text_q").mapInArrow(run, schema)


def _bitmap(ids: DataFrame) -> np.ndarray:
    """A filter of FILTER_BITS bits (2 MB) that holds all the ids."""
    at = F.col("id").bitwiseAND(F.lit(FILTER_BITS - 1))
    words = ids.groupBy(F.shiftright(at, 6).alias("word")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast(id & 63 as int))")).alias("bits")).toArrow()
    out = np.zeros(FILTER_BITS >> 6, np.int64)
    out[words.column("word").to_numpy()] = words.column("bits").to_numpy()
    return out


def _texts_of(docs: DataFrame, ids: DataFrame, k: int, reach: Reach) -> DataFrame:
    """id, text, size and part marks: one text for each wanted set.

    Tasks pass on the texts that a small filter lets through, each set once a task; so the
    documents are read again but not shuffled.
    """
    sent = docs.sparkSession.sparkContext.broadcast(_bitmap(ids))
    schema = "id long, text string, size long, own_marks binary, next_marks binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, seen = sent.value, set()
        for batch in batches:
            for i, j, data, offsets in textkit.text_chunks(batch.column(0)):
                doc, value = textkit.shingles(data, offsets, k)
                sizes, names = set_ids(doc, value, j - i)
                slot = names & (FILTER_BITS - 1)
                want = (bits[slot >> 6] >> (slot & 63) & 1 > 0) & (sizes > 0)
                take = [x for x in np.flatnonzero(want) if not (names[x] in seen or seen.add(names[x]))]
                if take:
                    ring = np.searchsorted(reach.bounds, sizes, side="right") - 1
                    out = np.ones(j - i, bool)
                    out[take] = False
                    own, following = np.where(out, -1, ring), np.where(out, -1, ring + 1)
                    marks = [part_marks(doc, value, x, reach) for x in (own, following)]
                    text = batch.column(0).slice(i, j - i).take(pa.array(take))
                    yield textkit.batch(schema, names[take], text, sizes[take], *([m[x] for x in take] for m in marks))

    found = docs.select("text").mapInArrow(run, schema)
    return found.join(ids.select("id"), "id", "left_semi").dropDuplicates(["id"])


def _alone(texts: DataFrame, k: int) -> DataFrame:
    """id, alone: how many shingles of each set of `texts` (id, text) no other one of them has; no row for none."""
    schema = "id long, shingle long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, offsets in textkit.text_chunks(batch.column(1)):
                doc, value = textkit.shingles(data, offsets, k)
                yield textkit.batch(schema, batch.column(0).to_numpy()[i:j][doc], value.view(np.int64))

    rows = texts.select("id", "text").mapInArrow(run, schema)
    single = rows.groupBy("shingle").agg(F.count("*").alias("n"), F.min("id").alias("id")).where("n = 1")
    return single.groupBy("id").agg(F.count("*").alias("alone"))


def jaccard_join(docs: DataFrame, k: int = K, num: int = NUMERATOR, den: int = DENOMINATOR) -> DataFrame:
    """doc_id, n_shingles, component_id of every row of `docs` (doc_id, text).

    Documents link when den * intersection >= num * union of their distinct k-word shingles
    (ASCII capitals lowered; fewer words than k: the whole sequence). component_id is the
    smallest doc_id reachable by links. Every link lies within a component; links inside one
    that is already connected are not looked for. Shingles and sets are told apart by 64 bits.

    Null, empty and blank texts have no shingles and are their own component (of the rows
    under their doc_id); equal texts link; rows repeated under one id give one row each; no
    rows give no rows; further columns do not matter.
    """
    base, by_root = _rooted(docs, k, num, den)
    least_of = by_root.groupBy("root").agg(F.min("low").alias("component_id"))
    named = by_root.join(least_of, "root").select("id", "component_id")
    out = base.join(named, "id")
    own = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "n_shingles", own.alias("component_id"))


def _rooted(docs: DataFrame, k: int, num: int, den: int) -> tuple[DataFrame, DataFrame]:
    """doc_id, n_shingles and id (of the set) of every row; id, low (its smallest doc_id) and root of every set."""
    spark = docs.sparkSession
    reach = Reach(num, den)
    schema = "doc_id long, n_shingles long, id long, counts array<long>"

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(SKETCH, np.int64)
        for batch in batches:
            for i, j, data, offsets in textkit.text_chunks(batch.column(1)):
                doc, value = textkit.shingles(data, offsets, k)
                counts += np.bincount((value & np.uint64(SKETCH - 1)).astype(np.int64), minlength=SKETCH)
                sizes, names = set_ids(doc, value, j - i)
                yield textkit.batch(schema, batch.column(0).slice(i, j - i), sizes, names, pa.nulls(j - i, pa.list_(pa.int64())))
        yield textkit.batch(schema, [None], [-1], [0], [counts])

    measured = freeze(docs.select("doc_id", "text").mapInArrow(measure, schema))
    base = measured.where("n_shingles >= 0").drop("counts")
    sketch = measured.where("n_shingles < 0").select(F.posexplode("counts").alias("at", "n")).groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(SKETCH, np.int64)
    counts[sketch.column("at").to_numpy()] = sketch.column("n").to_numpy()
    common = spark.sparkContext.broadcast(counts > max(64, COMMON * counts.mean()))
    cell_schema = "cell long, id long, least long"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = set()
        for batch in batches:
            for i, j, data, offsets in textkit.text_chunks(batch.column(0)):
                doc, value = textkit.shingles(data, offsets, k)
                sizes, names = set_ids(doc, value, j - i)
                fresh = np.array([not (x in known or known.add(x)) for x in names.tolist()], bool)
                which, cell = cells(doc, value, j - i, reach, common.value)
                own = fresh[which]
                least = reach.common(-(-num * sizes // den))  # of its smallest partner
                yield textkit.batch(cell_schema, cell[own].view(np.int64), names[which[own]], least[which[own]])

    rows = docs.select("text").mapInArrow(cut, cell_schema)
    several = rows.groupBy("cell").agg(F.min("id").alias("low"), F.max("id").alias("high")).where("low < high")
    members = freeze(rows.join(several.select("cell"), "cell").distinct())
    wanted = freeze(members.groupBy("id").agg(F.count("*").alias("n"), F.max("least").alias("least")).where("n >= least").select("id"))
    texts = freeze(_texts_of(docs, wanted, k, reach))
    # what a set shares with others bounds its intersections
    met = texts.select("id", "size").join(_alone(texts, k), "id", "left").withColumn("shared", F.col("size") - F.coalesce("alone", F.lit(0)))
    met = freeze(met.where(den * F.col("shared") >= num * F.col("size")).select("id", "size", "shared"))
    members = members.drop("least").join(met.select("id", (F.col("shared") / F.col("size")).alias("share")), "id")
    # cells with the same documents are one region
    alike = members.groupBy("cell").agg(
        F.count("*").alias("n"), F.sum(F.col("id").cast("decimal(38,0)")).alias("s"), F.bit_xor("id").alias("x"), F.max_by("id", F.struct("share", "id")).alias("pivot")
    )
    regions = alike.where("n > 1").groupBy("n", "s", "x", "pivot").agg(F.min("cell").alias("cell")).select("cell", "pivot")
    region = freeze(members.join(regions, "cell"))

    def compare(pairs: DataFrame) -> DataFrame:
        x, q = texts.select(F.col("id").alias("x"), F.col("text").alias("text_x")), texts.select(F.col("id").alias("q"), F.col("text").alias("text_q"))
        return freeze(linked(pairs.distinct().join(x, "x").join(q, "q"), k, num, den))

    def ends(pairs: DataFrame) -> DataFrame:
        return pairs.where("link").select(F.col("x").alias("a"), F.col("q").alias("b"))

    near = (den - num) / den + 1e-9
    open_rows, links, settled, before = region, None, [], None
    while True:
        # all documents of a region against its pivot
        checked = compare(open_rows.where("id != pivot").select(F.col("id").alias("x"), F.col("pivot").alias("q")))
        links = ends(checked) if links is None else links.unionByName(ends(checked))
        roots = freeze(components(links))
        far = open_rows.where("id != pivot").join(checked, (F.col("id") == F.col("x")) & (F.col("pivot") == F.col("q")))
        far = far.select("cell", "id", "share", "distance", (~F.col("link")).alias("free"))
        # what stays: those beyond reach of the pivot, and those whose distance allows a link with one of them
        least = far.where("free").groupBy("cell").agg(F.min("distance").alias("least"))
        state = far.join(least, "cell").where(F.col("free") | (F.col("distance") >= F.col("least") - near)).drop("least")
        state = state.join(roots, "id", "left").withColumn("root", F.coalesce("root", "id"))
        next_pivot = F.max_by(F.when(F.col("free"), F.col("id")), F.struct("free", "share", "id"))
        left = state.groupBy("cell").agg(F.min("root").alias("one"), F.max("root").alias("other"), F.count("*").alias("rows"), next_pivot.alias("pivot"))
        state = freeze(state.join(left.where("one < other").select("cell", "rows", "pivot"), "cell"))
        large = state.where(F.col("rows") > BLOCK)
        n = large.count()
        if not n or (before is not None and 2 * n > before):
            break
        settled.append(state.where(F.col("rows") <= BLOCK))
        open_rows, before = large.select("cell", "id", "share", "pivot"), n
    for earlier in settled:
        state = state.unionByName(earlier)
    state = state.select("cell", "id", "distance", "free").join(roots, "id", "left").withColumn("root", F.coalesce("root", "id"))
    together = state.groupBy("id").agg(F.collect_set("cell").alias("regions"))
    state = state.join(together, "id").join(met, "id").join(texts.select("id", "own_marks", "next_marks"), "id")
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = _blocks(state, BLOCK).select(*_OPEN).repartition(tasks, "cell", "a", "b").sortWithinPartitions("cell", "a", "b")
    pairs = freeze(dealt.mapInArrow(_may_link(reach), "x long, q long"))
    roots = freeze(components(links.unionByName(ends(compare(pairs)))))
    lowest = base.groupBy("id").agg(F.min("doc_id").alias("low"))
    return base, lowest.join(roots, "id", "left").withColumn("root", F.coalesce("root", "id"))


def keep_first(docs: DataFrame, k: int = K, num: int = NUMERATOR, den: int = DENOMINATOR) -> DataFrame:
    """The rows of `docs` whose document has its component's smallest id.

    Rows without an id stand behind those with one: a component in which no row has an id keeps
    one of its rows, any other none of those without. Null, empty and blank texts without an id
    are no copies of each other; all stay. Columns stay as they are, whatever their names.
    """
    key, size, name = private(docs, "id", "size", "set")
    base, by_root = _rooted(docs, k, num, den)
    first = freeze(by_root.groupBy("root").agg(F.min("low").alias("low"), F.min("id").alias("id")))
    blank = base.where((F.col("n_shingles") == 0) & F.col("doc_id").isNotNull()).select("doc_id")
    kept = first.where("low is not null").select(F.col("low").alias("doc_id")).unionByName(blank).select(F.col("doc_id").alias(key)).distinct()
    named = docs.join(kept, docs["doc_id"] == F.col(key), "left_semi")
    nameless = _with_sets(docs.where("doc_id is null"), k, size, name)
    alone = first.where("low is null").select(F.col("id").alias(name))
    one = nameless.where(F.col(size) > 0).join(alone, name, "left_semi").dropDuplicates([name])
    return named.unionByName(one.select(*docs.columns)).unionByName(nameless.where(F.col(size) == 0).select(*docs.columns))


def _with_sets(docs: DataFrame, k: int, size: str, name: str) -> DataFrame:
    """The rows of `docs` with the size and the id of their set of shingles under the names given."""
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, offsets in textkit.text_chunks(batch.column(at)):
                doc, value = textkit.shingles(data, offsets, k)
                sizes, names = set_ids(doc, value, j - i)
                columns = [*batch.slice(i, j - i).columns, pa.array(sizes, pa.int64()), pa.array(names, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, size, name])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(size, LongType()), StructField(name, LongType())]))
