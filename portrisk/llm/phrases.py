"""Phrase collocations by best-first branch and bound over prefix counts.

Words are counted first, then two-word prefixes. The count of a prefix bounds the scores of all
that can grow from it: a phrase of three words occurs at most as often as its first two words and
its last two, so its score is at most 1000000 * f(first two) / f(first) and at most
1000000 * f(last two) / f(last). The frontier is expanded from the best bound downwards, all
prefixes above a threshold at a time, together with the prefixes that score above it themselves,
for a longer phrase may drop them. All phrases that score at or above the threshold are then
known. A language is settled when they are as many as wanted; for the others the threshold falls.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from portrisk.llm import textkit
from portrisk.session import freeze

TOP, LEAST, OVERLAP = 2000, 10, 50
SCALE = 1_000_000
WORD_BITS = 1 << 23  # a filter of 1 MB for words that occur often enough
SLOTS = 1 << 21  # a table of 2 MB for what a two-word prefix is worth
RUN_WORDS = 1 << 21  # words that a task gathers before it sums them
BREAK = np.zeros(256, bool)
BREAK[[ord(c) for c in ".,;:!?\n\v\f\r"]] = True
APART = BREAK.copy()
APART[[0x20, 0x09]] = True
SCORES, OPENS, CLOSES, KNOWN = 1, 2, 4, 8  # flags of a two-word prefix
_STEP = np.uint64(0x9FB21C651E98DF25)


def _salt(lang: str, known: dict) -> np.uint64:
    if lang not in known:
        known[lang] = np.uint64(int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little"))
    return known[lang]


def _encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Lists of languages, then each word's hash with its language, piece, text number, start and end, and the bytes."""
    salts: dict = {}
    for batch in batches:
        langs = batch.column(1).to_pylist()
        for i, j, data, offsets in textkit.text_chunks(batch.column(0), 4 << 20):
            starts, ends, doc = textkit.words(data, offsets, APART)
            if not len(starts):
                continue
            salt = np.array([_salt(x, salts) for x in langs[i:j]], np.uint64)
            word = textkit.range_hash(textkit.prefix_sums(textkit.LOWER_VALUES[data]), starts, ends)
            piece = np.cumsum(BREAK[data])[starts] + doc
            yield langs[i:j], textkit.mix(word ^ salt[doc]), piece, doc, starts, ends, data


def word_counts(docs: DataFrame) -> DataFrame:
    """lang, word, w (its 64-bit name within the language), f."""
    schema = "lang string, word string, w long, f long"
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for langs, word, _, doc, starts, ends, data in _encoded(batches):
            w, first, f = np.unique(word, return_index=True, return_counts=True)
            small = lower[data].tobytes()
            spelled = [small[a:b].decode() for a, b in zip(starts[first].tolist(), ends[first].tolist(), strict=True)]
            yield textkit.batch(schema, [langs[d] for d in doc[first].tolist()], spelled, w.view(np.int64), f)

    return docs.mapInArrow(run, schema).groupBy("lang", "word", "w").agg(F.sum("f").alias("f"))


def _flags(table: np.ndarray, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return table[((first ^ (second >> np.uint64(20))) & np.uint64(len(table) - 1)).astype(np.int64)]


def _slot_column(first: str, second: str) -> Column:
    return F.col(first).bitwiseXOR(F.shiftrightunsigned(second, 20)).bitwiseAND(F.lit(SLOTS - 1))


def _bits(words: DataFrame) -> np.ndarray:
    """A filter of WORD_BITS bits that holds all the words w; at most 2^17 rows reach the driver."""
    at = F.col("w").bitwiseAND(F.lit(WORD_BITS - 1))
    found = words.groupBy(F.shiftright(at, 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(w & 63 as int))")).alias("bits")).toArrow()
    out = np.zeros(WORD_BITS >> 6, np.int64)
    out[found.column("word").to_numpy()] = found.column("bits").to_numpy()
    return out


def _table(flagged: DataFrame) -> np.ndarray:
    """The flags (w1, w2, flags) by slot, SLOTS bytes, as _flags() finds them; prefixes that meet in a slot share theirs."""
    found = flagged.groupBy(_slot_column("w1", "w2").cast("int").alias("slot")).agg(F.bit_or("flags").alias("flags")).toArrow()
    out = np.zeros(SLOTS, np.uint8)
    out[found.column("slot").to_numpy()] = found.column("flags").to_numpy()
    return out


def _summed(parts: list[tuple[np.ndarray, ...]], schema: str) -> pa.RecordBatch:
    """Equal rows of words once, with their number."""
    columns = [np.concatenate(x) for x in zip(*parts, strict=True)]
    key = columns[0]
    for column in columns[1:]:
        key = textkit.mix(key * _STEP + column)
    _, first, count = np.unique(key, return_index=True, return_counts=True)
    return textkit.batch(schema, *(c[first].view(np.int64) for c in columns), count)


def _counted(docs: DataFrame, words: int, wanted) -> DataFrame:
    """w1 .. w<words>, a: how often the chosen phrases occur; wanted(arrays of words) marks them."""
    names = [f"w{i + 1}" for i in range(words)]
    schema = ", ".join(f"{x} long" for x in names) + ", a long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, rows = [], 0
        for _, word, piece, *_ in _encoded(batches):
            m = len(word) - words + 1
            if m <= 0:
                continue
            at = np.flatnonzero(piece[:m] == piece[words - 1 :])
            phrase = tuple(word[at + i] for i in range(words))
            keep = wanted(*phrase)
            parts.append(tuple(x[keep] for x in phrase))
            rows += len(parts[-1][0])
            if rows >= RUN_WORDS:
                yield _summed(parts, schema)
                parts, rows = [], 0
        if rows:
            yield _summed(parts, schema)

    return docs.mapInArrow(run, schema).groupBy(*names).agg(F.sum("a").alias("a"))


def _score(a: str, left: str, right: str) -> Column:
    """floor(1000000 * a * a / (left * right)), exact for counts below 10^15."""
    wide = "cast({} as decimal(15,0))".format
    return F.expr(f"({wide(a)} * {wide(a)} * cast({SCALE} as decimal(7,0))) div ({wide(left)} * {wide(right)})")


def _bound(prefix: str, word: str) -> Column:
    return F.expr(f"cast({prefix} as decimal(18,0)) * cast({SCALE} as decimal(7,0)) div cast({word} as decimal(18,0))")


def _thresholds(prefixes: DataFrame, wanted: int) -> DataFrame:
    """lang, floor: the highest score that `wanted` prefixes of the language reach, 0 if there are not as many.

    Scores are whole numbers up to a million, so a language has at most as many rows here.
    """
    by_score = prefixes.groupBy("lang", "score").agg(F.count("*").alias("n"))
    upto = F.sum("n").over(Window.partitionBy("lang").orderBy(F.desc("score")))
    return by_score.withColumn("upto", upto).groupBy("lang").agg(F.coalesce(F.max(F.when(F.col("upto") >= wanted, F.col("score"))), F.lit(0)).alias("floor"))


def _grown(docs: DataFrame, prefixes: DataFrame, words: DataFrame, floors: DataFrame, least: int) -> DataFrame:
    """Phrases of three words that may score at the floor, or that may drop a prefix which does."""
    frontier = prefixes.join(floors, "lang")
    flag = lambda test, value: F.when(test, value).otherwise(0)
    flags = flag(F.col("score") >= F.col("floor"), SCORES).bitwiseOR(flag(_bound("a", "l") >= F.col("floor"), OPENS))
    flags = flags.bitwiseOR(flag(_bound("a", "r") >= F.col("floor"), CLOSES)).bitwiseOR(F.lit(KNOWN))
    sent = docs.sparkSession.sparkContext.broadcast(_table(frontier.select("w1", "w2", flags.alias("flags"))))

    def wanted(first, second, third):
        left, right = _flags(sent.value, first, second), _flags(sent.value, second, third)
        return (left & OPENS > 0) & (right & CLOSES > 0) | (left & SCORES > 0) & (right & KNOWN > 0) | (left & KNOWN > 0) & (right & SCORES > 0)

    found = _counted(docs, 3, wanted).where(F.col("a") >= least)
    before = frontier.select("w1", "w2", F.col("a").alias("front"), F.col("l").alias("first"), "lang", "floor")
    after = prefixes.select(F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("a").alias("back"), F.col("r").alias("last"))
    found = found.join(before, ["w1", "w2"]).join(after, ["w2", "w3"])
    found = found.withColumns({"one": _score("a", "first", "back"), "two": _score("a", "front", "last")})
    early = F.col("one") <= F.col("two")
    pick = lambda x, y: F.when(early, F.col(x)).otherwise(F.col(y))
    return freeze(found.select("lang", "floor", "w1", "w2", "w3", "a", pick("first", "front").alias("l"), pick("back", "last").alias("r"), F.least("one", "two").alias("score")))


def _surviving(prefixes: DataFrame, grown: DataFrame, floors: DataFrame, overlap: int) -> DataFrame:
    """All phrases that reach their language's floor and that no longer phrase drops."""
    inner = F.explode(F.array(F.struct("w1", "w2", "a"), F.struct(F.col("w2").alias("w1"), F.col("w3").alias("w2"), "a")))
    longest = grown.select(inner.alias("x")).groupBy("x.w1", "x.w2").agg(F.max("x.a").alias("longer"))
    pairs = prefixes.join(floors, "lang").where("score >= floor").join(longest, ["w1", "w2"], "left")
    pairs = pairs.where(F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * overlap))
    names = ["lang", "floor", "w1", "w2", "w3", "a", "l", "r", "score"]
    return pairs.withColumn("w3", F.lit(None).cast("long")).select(*names).unionByName(grown.where("score >= floor").select(*names))


def collocations(docs: DataFrame, top: int = TOP, least: int = LEAST, overlap: int = OVERLAP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's first `top` phrases of two and three words.

    Texts of `docs` (text, lang) are lowered (A-Z), cut into pieces at . , ; : ! ? and line ends and
    into words at blanks and tabs; phrases stay within a piece. A phrase with a = f(phrase) >= `least`
    scores floor(1000000 * a^2 / (l * r)) at its worst cut into l = f(first part) and r = f(rest), the
    earliest of equal ones. It drops out inside a longer one with 100 * f(longer) >= `overlap` * a. Order:
    score, a (both falling), phrase (by code point); n counts the language's words.

    A null language is `und`, with texts that name it so; null and empty texts have no words; repeated
    rows count again; no rows, or no phrase that is frequent enough, give no rows; further columns do
    not matter. Words are told apart by 64-bit hashes. Two tables of fixed size (1 and 2 MB) are
    broadcast; they only spare counting, and what they let through by chance is dropped by its count.
    """
    docs = docs.select(F.coalesce("text", F.lit("")).alias("text"), F.coalesce("lang", F.lit("und")).alias("lang"))
    counts = freeze(word_counts(docs))
    words = counts.where(F.col("f") >= least)
    sent = docs.sparkSession.sparkContext.broadcast(_bits(words))

    def frequent(*phrase):
        keep = np.ones(len(phrase[0]), bool)
        for word in phrase:
            slot = (word & np.uint64(64 * len(sent.value) - 1)).astype(np.int64)
            keep &= sent.value[slot >> 6] >> (slot & 63) & 1 > 0
        return keep

    first = words.select("lang", F.col("w").alias("w1"), F.col("f").alias("l"))
    second = words.select(F.col("w").alias("w2"), F.col("f").alias("r"))
    pairs = _counted(docs, 2, frequent).where(F.col("a") >= least).join(first, "w1").join(second, "w2")
    prefixes = freeze(pairs.withColumn("score", _score("a", "l", "r")).select("lang", "w1", "w2", "a", "l", "r", "score"))

    done, left, wanted = None, prefixes, 2 * top
    while True:
        floors = freeze(_thresholds(left, wanted))
        grown = _grown(docs, left, words, floors, least)
        found = freeze(_surviving(left, grown, floors, overlap))
        reached = found.groupBy("lang").agg(F.count("*").alias("reached"))
        settled = floors.join(reached, "lang", "left").where((F.col("floor") == 0) | (F.col("reached") >= top)).select("lang")
        known = found.join(settled, "lang")
        done = known if done is None else done.unionByName(known)
        left = freeze(left.join(settled, "lang", "left_anti"))
        if left.isEmpty():
            break
        wanted *= 4

    spelled = words.select("w", "word")
    for i in (1, 2, 3):
        name = spelled.select(F.col("w").alias(f"w{i}"), F.col("word").alias(f"word{i}"))
        done = done.join(name, f"w{i}", "left" if i == 3 else "inner")
    totals = counts.groupBy("lang").agg(F.sum("f").alias("n"))
    ranked = done.withColumn("phrase", F.concat_ws(" ", "word1", "word2", "word3")).withColumn(
        "rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    )
    return ranked.where(F.col("rank") <= top).join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))
