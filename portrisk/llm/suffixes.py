"""Suffix-array dedup: bytes covered by long strings that an earlier document has too.

Two equal strings of `length` bytes have the same anchor, the smallest k-gram hash in them. So
strings around equal anchors meet in one shard and no match is lost between shards. In a shard
the suffixes are sorted by induced sorting: the suffixes at local minima first, then all others
from them through one queue per first byte, a monotone priority queue that is read and filled in
bulk. Neighbours with a common prefix of `length` bytes are one string. Shards are bounded by
their number; what exceeds memory lies in the exchange that sorts strings into shards.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portrisk.llm import textkit
from portrisk.session import freeze

LENGTH, GRAM = 50, 20
CHUNK = 256 << 10
FLUSH_BYTES = 8 << 20
BUCKET_BYTES, SHARD_BYTES = 8 << 20, 1 << 20
FILTER_BITS = 1 << 27
HOT_DOCS, SALTS = 20_000, 64
_HALF = np.uint64(32)
_LOW = np.uint64(0xFFFFFFFF)


def anchors(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, k: int = GRAM):
    """(first start, count, anchor hash, text number, sums): runs of strings that share an anchor.

    Anchors are the least of many hashes, so they are mixed once more; parts of the hash space then hold like numbers.
    """
    n, none = len(data), np.zeros(0, np.int64)
    sums = textkit.prefix_sums(textkit.BYTE_VALUES[data])
    if n < length:
        return none, none, none.view(np.uint64), none, sums
    m, w = n - k + 1, length - k + 1
    gram = textkit.mix((sums[k:] - sums[:-k]) * textkit._tables(n + 1)[1][:m])
    least = (gram & ~_LOW) | np.arange(m, dtype=np.uint64)  # the first of equals
    done = 1
    while done < w:
        step = min(done, w - done)
        least = np.minimum(least[: len(least) - step], least[step:])
        done += step
    at = (least & _LOW).astype(np.int64)
    fresh = np.ones(len(at), bool)
    fresh[1:] = at[1:] != at[:-1]
    sizes = np.diff(offsets)
    fits = np.zeros(n, bool)
    for a, b in zip(offsets[:-1][sizes >= length].tolist(), offsets[1:][sizes >= length].tolist(), strict=True):
        fits[a : b - length + 1] = True
        fresh[a] = True
    fits = fits[: len(at)]
    starts = np.flatnonzero(fits)
    if not len(starts):
        return none, none, none.view(np.uint64), none, sums
    head = np.flatnonzero(fresh[starts])
    first = starts[head]
    count = np.diff(np.append(head, len(starts)))
    return first, count, textkit.mix(gram[at[first]]), np.searchsorted(offsets[1:], first, side="right"), sums


class Buckets:
    """Where the hash space is cut, and a filter with a slice for each part."""

    def __init__(self, total_bytes: int) -> None:
        self.n = max(8, -(-total_bytes // BUCKET_BYTES))
        bits = min(FILTER_BITS, max(total_bytes, 1 << 16)) // self.n
        self.widths = max(512, bits // 8 * 8), max(512, bits // 64 // 8 * 8)  # common anchors are few

    def of(self, value: np.ndarray) -> np.ndarray:
        return ((value >> _HALF) * np.uint64(self.n) >> _HALF).astype(np.int64)

    def bit(self, low: np.ndarray, which: int) -> np.ndarray:
        return (textkit.mix(low.astype(np.uint64)) % np.uint64(self.widths[which])).astype(np.int64)

    def holds(self, filters: list[np.ndarray], which: int, value: np.ndarray) -> np.ndarray:
        found, part = np.ones(len(value), bool), self.of(value)
        for probe in (value & _LOW, ~value & _LOW):
            at = self.bit(probe, which)
            found &= filters[which][part, at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1 > 0
        return found


def _seen_in(docs: DataFrame, buckets: Buckets, length: int, k: int, hot_docs: int) -> list[np.ndarray]:
    """Filters over anchors: those of two or more documents, and those of very many.

    Each task counts its documents by anchor; a part of the hash space gets one packed row a
    task, so no anchor brings more than one entry a task. Only the filters, little more
    than FILTER_BITS, reach the driver.
    """
    schema = "bucket int, low binary, docs binary"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush():
            value = np.concatenate([h for h, _ in held])
            doc = np.concatenate([d for _, d in held])
            order = np.lexsort((doc, value))
            value, doc = value[order], doc[order]
            first = np.flatnonzero(np.concatenate([[True], value[1:] != value[:-1]]))
            other = np.concatenate([[True], (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])])
            n = np.add.reduceat(other.astype(np.uint32), first)
            value = value[first]
            bucket = buckets.of(value)
            cut = np.searchsorted(bucket, np.arange(buckets.n + 1))
            low = (value & _LOW).astype(np.uint32)
            some = [b for b in range(buckets.n) if cut[b + 1] > cut[b]]
            return textkit.batch(schema, some, [low[cut[b] : cut[b + 1]].tobytes() for b in some], [n[cut[b] : cut[b + 1]].astype(np.uint32).tobytes() for b in some])

        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for i, j, data, offsets in textkit.text_chunks(batch.column(1), CHUNK):
                _, _, value, doc, _ = anchors(data, offsets, length, k)
                if len(value):
                    held.append((value, ids[i:j][doc]))
                size += len(data)
                if size >= 2 * FLUSH_BYTES and held:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    def merge(group: pd.DataFrame) -> pd.DataFrame:
        low = np.concatenate([np.frombuffer(x, np.uint32) for x in group["low"]])
        n = np.concatenate([np.frombuffer(x, np.uint32) for x in group["docs"]]).astype(np.int64)
        order = np.argsort(low, kind="stable")
        low, n = low[order], n[order]
        first = np.flatnonzero(np.concatenate([[True], low[1:] != low[:-1]]))
        n, low = np.add.reduceat(n, first), low[first]
        out = {"bucket": [int(group["bucket"].iloc[0])]}
        for which, (name, least) in enumerate((("shared", 2), ("hot", hot_docs))):
            bits = np.zeros(buckets.widths[which], bool)
            bits[buckets.bit(low[n >= least], which)] = bits[buckets.bit(~low[n >= least], which)] = True
            out[name] = [np.packbits(bits).tobytes()]
        return pd.DataFrame(out)

    found = docs.mapInArrow(count, schema).groupBy("bucket").applyInPandas(merge, "bucket int, shared binary, hot binary").toArrow()
    filters = [np.zeros((buckets.n, width // 8), np.uint8) for width in buckets.widths]
    for bucket, *parts in zip(*(c.to_pylist() for c in found.columns), strict=True):
        for i, part in enumerate(parts):
            filters[i][bucket] = np.frombuffer(part, np.uint8)
    return filters


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Starts of the suffixes of `text` (symbols from 1), sorted by their first `depth` symbols at least."""
    n = len(text)
    s = np.zeros(n + 1, np.uint16)
    s[:n] = text
    change = np.flatnonzero(s[:-1] != s[1:])
    rising = np.ones(n + 1, bool)  # S-type: smaller than the suffix after it
    rising[:n] = (s[change] < s[change + 1])[np.searchsorted(change, np.arange(n))]
    lms = np.flatnonzero(rising[1:] & ~rising[:-1]) + 1
    by_symbol = lms[np.argsort(s[lms], kind="stable")]
    order = _induce(s, rising, by_symbol)
    is_lms = np.zeros(n + 1, bool)
    is_lms[lms] = True
    sorted_lms = np.concatenate([[n], order[is_lms[order]]])
    # name the pieces between local minima in their order
    place = np.searchsorted(lms, sorted_lms)
    ends = np.minimum(np.append(lms[1:], n)[place] + 1, n + 1)
    sums = textkit.prefix_sums(textkit.mix(s.astype(np.uint64) + np.uint64(1)))
    piece = textkit.range_hash(sums, sorted_lms, ends) ^ textkit.mix((ends - sorted_lms).astype(np.uint64))
    name = np.concatenate([[0], np.cumsum(piece[1:] != piece[:-1])])
    rank = np.empty(len(lms), np.int64)
    rank[place] = name
    step = 1  # pieces already compared; each has two symbols at least
    while rank.max() + 1 < len(rank) and 2 * step < depth + 4:
        after = np.full(len(rank), -1)
        after[:-step] = rank[step:]
        by_pair = np.lexsort((after, rank))
        a, b = rank[by_pair], after[by_pair]
        rank[by_pair] = np.concatenate([[0], np.cumsum((a[1:] != a[:-1]) | (b[1:] != b[:-1]))])
        step *= 2
    return _induce(s, rising, lms[np.argsort(rank, kind="stable")])


def _induce(s: np.ndarray, rising: np.ndarray, lms: np.ndarray) -> np.ndarray:
    """All suffixes but the empty one, from the ordered ones at local minima.

    Symbols are visited up and then down; a visited suffix hands the one before it to the queue
    of that one's symbol, so every queue is filled in its final order before it is read.
    """
    symbols = np.unique(s).tolist()
    cuts = np.searchsorted(s[lms[np.argsort(s[lms], kind="stable")]], symbols)
    grouped = np.split(lms[np.argsort(s[lms], kind="stable")], cuts[1:])
    seeds = dict(zip(symbols, grouped, strict=True))
    falling: dict[int, list] = defaultdict(list)

    def hand_on(queue: dict[int, list], visited: np.ndarray, kind: bool, same: int) -> np.ndarray:
        before = visited[visited > 0] - 1
        before = before[rising[before] == kind]
        symbol = s[before]
        again = before[symbol == same]
        before, symbol = before[symbol != same], symbol[symbol != same]
        if len(before):
            order = np.argsort(symbol, kind="stable")
            before, symbol = before[order], symbol[order]
            edges = np.flatnonzero(symbol[1:] != symbol[:-1]) + 1
            for part in np.split(before, edges):
                queue[int(s[part[0]])].append(part)
        return again

    done: dict[int, list] = {}
    for c in symbols:
        done[c] = []
        current = np.concatenate(falling.pop(c)) if c in falling else lms[:0]
        while len(current):
            done[c].append(current)
            current = hand_on(falling, current, False, c)
        hand_on(falling, seeds[c], False, c)
    climbing: dict[int, list] = defaultdict(list)
    out = []
    for c in reversed(symbols):
        upper = []
        current = np.concatenate(climbing.pop(c)) if c in climbing else lms[:0]
        while len(current):
            upper.append(current)
            current = hand_on(climbing, current, True, c)
        lower = np.concatenate(done[c]) if done[c] else lms[:0]
        hand_on(climbing, lower[::-1], True, c)
        out += [*upper, lower[::-1]]
    return np.concatenate(out)[::-1]


def equal_windows(text: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """A number for each start, equal where `length` symbols from there are equal."""
    order = suffix_array(text, length)
    wanted = np.zeros(len(text) + 1, bool)
    wanted[starts] = True
    order = order[wanted[order]]
    same = np.ones(max(0, len(order) - 1), bool)
    for i in range(length):
        same &= text[order[1:] + i] == text[order[:-1] + i]
    number = np.zeros(len(text) + 1, np.int64)
    number[order] = np.concatenate([[0], np.cumsum(~same)])
    return number[starts]


OPEN = "shard long, salted boolean, hash binary, doc binary, start binary, size binary, text binary"
SPANS = "doc long, start long, stop long, window long, check long"


def _spread(first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """first, first + 1, ... for each of the given sizes, one after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - sizes, sizes) + np.repeat(first, sizes)


def _strings(docs: DataFrame, filters, buckets: Buckets, shards: int, length: int, k: int) -> DataFrame:
    """Strings around shared anchors, packed by shard; shard -1 - x holds spans already known to repeat.

    Of equal strings within a few MB only those of the first document are sent on.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sieve = filters.value
        held, size = [], 0

        def flush():
            value, doc, start, count, key, text = (np.concatenate(x) for x in zip(*held, strict=True))
            sizes = count + length - 1
            order = np.lexsort((doc, key))
            first = np.concatenate([[True], key[order][1:] != key[order][:-1]])
            least = doc[order][np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))]
            known = np.zeros(len(order), bool)
            known[order] = doc[order] > least
            rows = []
            if known.any():
                spans = np.stack([doc[known], start[known], start[known] + sizes[known]])
                rows.append((-1 - int(textkit.mix(doc[:1].astype(np.uint64))[0] & np.uint64(0xFFFF)), False, b"", *(x.astype(np.int64).tobytes() for x in spans), b""))
            at = np.concatenate([[0], np.cumsum(sizes)])
            left = np.flatnonzero(~known)
            is_hot = buckets.holds(sieve, 1, value[left])
            salt = np.where(is_hot, 1 + (textkit.mix(doc[left].astype(np.uint64)) % np.uint64(SALTS)).astype(np.int64), 0)
            shard = (textkit.mix(value[left] + salt.astype(np.uint64)) % np.uint64(shards)).astype(np.int64) * 2 + is_hot
            left = left[np.argsort(shard, kind="stable")]
            shard = np.sort(shard, kind="stable")
            cuts = np.flatnonzero(np.concatenate([[True], shard[1:] != shard[:-1], [True]])) if len(left) else []
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                x = left[a:b]
                rows.append((
                    int(shard[a]), bool(shard[a] & 1), (value[x] & _LOW).astype(np.uint32).tobytes(), doc[x].tobytes(), _narrow(start[x]),
                    sizes[x].astype(_size_kind(length)).tobytes(), text[_spread(at[x], sizes[x])].tobytes(),
                ))
            return textkit.batch(OPEN, *(list(c) for c in zip(*rows, strict=True)))

        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for i, j, data, offsets in textkit.text_chunks(batch.column(1), CHUNK):
                first, count, value, doc, sums = anchors(data, offsets, length, k)
                if len(first):
                    keep = buckets.holds(sieve, 0, value)
                    first, count, value, doc = first[keep], count[keep], value[keep], doc[keep]
                    sizes = count + length - 1
                    key = textkit.range_hash(sums, first, first + sizes) + sizes.astype(np.uint64)
                    held.append((value, ids[i:j][doc].astype(np.int64), first - offsets[doc], count, key, data[_spread(first, sizes)]))
                size += len(data)
                if size >= FLUSH_BYTES and held:
                    if any(len(h[0]) for h in held):
                        yield flush()
                    held, size = [], 0
        if held and any(len(h[0]) for h in held):
            yield flush()

    return docs.mapInArrow(run, OPEN)


def _size_kind(length: int):
    """The type that holds the size of any string around an anchor, which is below twice `length`."""
    return np.uint8 if 2 * length <= 256 else np.uint32


def _narrow(x: np.ndarray) -> bytes:
    return x.astype(np.uint32 if x.max(initial=0) < 1 << 32 else np.int64).tobytes()


def _wide(raw: bytes, n: int) -> np.ndarray:
    return np.frombuffer(raw, np.uint32 if len(raw) == 4 * n else np.int64).astype(np.int64)


def _unpacked(group: pd.DataFrame, name: str, kind) -> np.ndarray:
    return np.concatenate([np.frombuffer(x, kind) for x in group[name]])


def _resolve(length: int):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        doc = _unpacked(group, "doc", np.int64)
        if group["shard"].iloc[0] < 0:
            start = _unpacked(group, "start", np.int64)
            stop = _unpacked(group, "size", np.int64)
            return _merged(doc, start, stop)
        salted = bool(group["salted"].iloc[0])
        start = np.concatenate([_wide(x, len(d) // 8) for x, d in zip(group["start"], group["doc"], strict=True)])
        # half of an anchor's hash: within a shard more never parts equal anchors
        value, size = _unpacked(group, "hash", np.uint32), _unpacked(group, "size", _size_kind(length)).astype(np.int64)
        text = _unpacked(group, "text", np.uint8)
        at = np.concatenate([[0], np.cumsum(size)])
        sums = textkit.prefix_sums(textkit.BYTE_VALUES[text])
        key = textkit.range_hash(sums, at[:-1], at[1:]) + size.astype(np.uint64)
        order = np.lexsort((doc, key, value))
        v, s, d = value[order], key[order], doc[order]
        new_string = np.concatenate([[True], (v[1:] != v[:-1]) | (s[1:] != s[:-1])])
        string = np.cumsum(new_string) - 1
        head = order[new_string]
        least = d[new_string]
        later = d > least[string]
        spans = [(d[later], start[order][later], start[order][later] + size[order][later])]
        # strings of anchors with one string only hold no further match
        anchor = value[head]
        alone = np.concatenate([[True], anchor[1:] != anchor[:-1]]) & np.concatenate([anchor[1:] != anchor[:-1], [True]])
        many = np.flatnonzero(~alone | salted)
        opened = []
        if len(many):
            sizes = size[head[many]]
            symbols = np.ones(int(sizes.sum()) + len(many), np.uint16)  # 1 parts the strings
            base = np.concatenate([[0], np.cumsum(sizes + 1)])[:-1]
            symbols[_spread(base, sizes)] = text[_spread(at[head[many]], sizes)].astype(np.uint16) + 2
            windows = sizes - length + 1
            begins = _spread(base, windows)
            of = np.repeat(many, windows)
            number = equal_windows(symbols, begins, length)
            first_doc = np.full(int(number.max()) + 1, np.iinfo(np.int64).max)
            np.minimum.at(first_doc, number, least[of])
            repeated = least[of] > first_doc[number]
            offset = begins - np.repeat(base, windows)
            # every copy of the string in its first document loses the same bytes
            owners = np.flatnonzero(~later)
            by_string = np.searchsorted(string[owners], np.arange(len(head) + 1))
            def owned(chosen):
                n = by_string[of[chosen] + 1] - by_string[of[chosen]]
                row = order[owners[_spread(by_string[of[chosen]], n)]]
                return np.repeat(chosen, n), row
            which, row = owned(np.flatnonzero(repeated))
            begin = start[row] + offset[which]
            spans.append((doc[row], begin, begin + length))
            if salted:  # other parts of this anchor are in other shards
                which, row = owned(np.flatnonzero(~repeated))
                begin = start[row] + offset[which]
                hashed = textkit.range_hash(textkit.prefix_sums(textkit.BYTE_VALUES[(symbols & 255).astype(np.uint8)]), begins[which], begins[which] + length)
                again = textkit.range_hash(textkit.prefix_sums(textkit.mix(symbols.astype(np.uint64))), begins[which], begins[which] + length)
                opened.append(pd.DataFrame({"doc": doc[row], "start": begin, "stop": begin + length, "window": hashed.view(np.int64), "check": again.view(np.int64)}))
        merged = _merged(*(np.concatenate(x) for x in zip(*spans, strict=True)))
        return pd.concat([merged, *opened]) if opened else merged

    return run


def _merged(doc: np.ndarray, start: np.ndarray, stop: np.ndarray) -> pd.DataFrame:
    """Spans joined where they touch."""
    if not len(doc):
        return pd.DataFrame({c: pd.Series([], dtype="Int64") for c in ("doc", "start", "stop", "window", "check")})
    order = np.lexsort((start, doc))
    doc, start, stop = doc[order], start[order], stop[order]
    group = np.concatenate([[0], np.cumsum(doc[1:] != doc[:-1])])
    shift = group * (int(stop.max()) + 1)
    reach = np.maximum.accumulate(stop + shift)
    fresh = np.concatenate([[True], start[1:] + shift[1:] > reach[:-1]])
    first = np.flatnonzero(fresh)
    last = np.append(first[1:], len(doc)) - 1
    nothing = pd.array([None] * len(first), dtype="Int64")
    return pd.DataFrame({"doc": doc[first], "start": start[first], "stop": reach[last] - shift[first], "window": nothing, "check": nothing})


def repeated_spans(docs: DataFrame, length: int = LENGTH, k: int = GRAM, hot_docs: int = HOT_DOCS) -> DataFrame:
    """doc, start, stop: bytes covered by a `length`-byte string that also starts in a smaller document.

    Spans of a document may overlap. Rows without an id take no part.
    """
    spark = docs.sparkSession
    rows = docs.where("doc_id is not null").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    total = int(docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0)
    buckets = Buckets(total)
    filters = spark.sparkContext.broadcast(_seen_in(rows, buckets, length, k, hot_docs))
    shards = max(8, -(-total // SHARD_BYTES))
    found = _strings(rows, filters, buckets, shards, length, k).groupBy("shard").applyInPandas(_resolve(length), SPANS)
    if filters.value[1].any():
        return _across_salts(found)
    return found.select("doc", "start", "stop")


def _across_salts(found: DataFrame) -> DataFrame:
    """Windows of very common anchors are compared once more over all shards, by two hashes."""
    found = freeze(found)
    opened = found.where("window is not null")
    least = opened.groupBy("window", "check").agg(F.min("doc").alias("least"))
    more = opened.join(least, ["window", "check"]).where("doc > least").select("doc", "start", "stop")
    return found.where("window is null").select("doc", "start", "stop").unionByName(more)


def dedup(docs: DataFrame, length: int = LENGTH, **options) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, text of every row of `docs` (doc_id, text).

    `text` is what is left as bytes. Null is the empty text; a text below `length` bytes loses
    nothing; repeated rows under one id do not count as earlier ones and lose the same bytes;
    rows without an id lose nothing; no rows give no rows.
    """
    spans = repeated_spans(docs, length, **options).groupBy("doc").agg(F.collect_list("start").alias("starts"), F.collect_list("stop").alias("stops"))
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, text binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, starts, stops = (batch.column(c).to_pylist() for c in (0, 2, 3))
            data, offsets = textkit.byte_column(batch.column(1))
            out = []
            for i, doc in enumerate(ids):
                text = data[offsets[i] : offsets[i + 1]]
                edge = np.zeros(len(text) + 1, np.int64)
                if starts[i]:
                    np.add.at(edge, np.array(starts[i]), 1)
                    np.add.at(edge, np.array(stops[i]), -1)
                gone = np.cumsum(edge)[:-1] > 0
                kept = text[~gone].tobytes()
                begins = gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum()
                out.append((doc, len(text), int(gone.sum()), int(begins), hashlib.sha256(kept).hexdigest(), kept))
            if out:
                yield textkit.batch(schema, *(list(x) for x in zip(*out, strict=True)))

    joined = docs.select("doc_id", "text").join(spans, F.col("doc_id") == F.col("doc"), "left").select("doc_id", "text", "starts", "stops")
    return joined.mapInArrow(run, schema)
