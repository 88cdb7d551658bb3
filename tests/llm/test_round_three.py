"""Whitening, phrases and min-max near-duplicates against brute force, with nulls, ties and clashing names."""

import itertools
import random
import re
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest

from portrisk.llm import minmax, phrases, whitening

CLASHES = "x int, w int, a int, n int, rank int, root int, band int, copies int, at int"


def clash(schema):
    return f"{schema}, {CLASHES}"


PAD = tuple(range(9))


# whitening


def whitened_by_hand(vectors, weights="counts", most=8):
    x = np.array([[int(np.floor(1024 * c)) + 100000 for c in v] for v in vectors], np.int64)
    fit = x if weights == "counts" else np.unique(x, axis=0)
    n, s = len(fit), fit.sum(axis=0)
    centred = fit - s / n
    value, vector = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-value)[:most]
    order = order[value[order] > 1e-9 * value.sum()]
    deviation = [sum((n * int(a) - int(b)) ** 2 for a, b in zip(row, s, strict=True)) for row in x]
    return n, deviation, (x - s / n) @ vector[:, order] / np.sqrt(value[order]), value[order] / value.sum()


@pytest.mark.parametrize("weights", ["counts", "one"])
def test_whitening(spark, weights):
    rng = np.random.default_rng(4)
    base = (rng.normal(size=(40, 12)) * np.linspace(3, 0.2, 12)).astype(np.float32)
    vectors = np.concatenate([base, base[:1].repeat(60, axis=0), base[5:9]]).tolist()
    bad = [None, [None] * 12, [float("nan")] * 12, [float("inf")] + [0.0] * 11, [3e38] * 12, [], [1.0, 2.0]]
    ids = [*range(len(vectors) - 2), None, 3]
    rows = [(i, v, *PAD) for i, v in zip(ids, vectors, strict=True)] + [(1000 + i, v, *PAD) for i, v in enumerate(bad)]
    df = spark.createDataFrame(rows, clash("vec_id long, embedding array<float>")).repartition(5)
    got = whitening.whiten(df, weights=weights).collect()
    n, deviation, expected, share = whitened_by_hand(vectors, weights)
    assert len(got) == len(vectors) * 8
    sign = {}
    by_id = {}
    for r in got:
        by_id.setdefault(r.vec_id, []).append(r)
        assert r.n == n and abs(r.explained / share[r.component - 1] - 1) < 1e-9 and 0 <= r.identity_error
        if weights == "counts":
            assert r.identity_error < 1e-9
    for at, i in enumerate(ids[:-1]):
        if i in (None, 3):
            continue
        for r in by_id[i]:
            want = expected[at, r.component - 1]
            assert int(r.deviation) == deviation[at]
            sign.setdefault(r.component, np.sign(r.whitened * want) or 1)
            assert abs(r.whitened * sign[r.component] - want) < 1e-8
    assert len(by_id[None]) == 8 and len(by_id[3]) == 16


def test_whitening_is_exact_for_large_entries(spark):
    vectors = [[2.0**50, -(2.0**50)], [1.0, 5.0], [2.0**45, 0.0]]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    got = {r.vec_id: int(r.deviation) for r in whitening.whiten(df).collect() if r.deviation is not None}
    _, deviation, _, _ = whitened_by_hand(vectors[1:])
    x = [[int(Fraction(c) * 1024 // 1) + 100000 for c in v] for v in vectors]
    sums = [sum(c) for c in zip(*x, strict=True)]
    for i, row in enumerate(x):
        assert got[i] == sum((3 * a - s) ** 2 for a, s in zip(row, sums, strict=True))


def test_whitening_without_variance(spark):
    schema = "vec_id long, embedding array<float>"
    for rows in ([], [(1, None)], [(1, [])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]):
        got = whitening.whiten(spark.createDataFrame(rows, schema))
        assert got.count() == 0
        assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    rank_one = spark.createDataFrame([(1, [1.0, 2.0]), (2, [2.0, 4.0]), (3, [4.0, 8.0])], schema)
    assert {r.component for r in whitening.whiten(rank_one).collect()} == {1}


# phrases


def phrases_by_hand(rows, top, least, overlap=50):
    out = []
    by_lang = {}
    for text, lang in rows:
        by_lang.setdefault(lang or "und", []).append(text or "")
    for lang, texts in by_lang.items():
        f = Counter()
        for text in texts:
            lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
            for piece in re.split("[.,;:!?\n\v\f\r]", lowered):
                words = tuple(w for w in re.split("[ \t]+", piece) if w)
                for k in (1, 2, 3):
                    f.update(words[i : i + k] for i in range(len(words) - k + 1))
        n = sum(v for p, v in f.items() if len(p) == 1)
        longer = {p: v for p, v in f.items() if len(p) == 3 and v >= least}
        found = []
        for p, a in f.items():
            if len(p) == 1 or a < least:
                continue
            if len(p) == 2 and any(100 * v >= overlap * a and p in (q[:2], q[1:]) for q, v in longer.items()):
                continue
            score, k = min((1000000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p), f[p[:k]], f[p[k:]]))
        found.sort(key=lambda x: (x[0], x[1], x[2].encode()))
        out += [(lang, i + 1, x[2], -x[1], x[3], x[4], n, -x[0]) for i, x in enumerate(found[:top])]
    return sorted(out)


def prose(seed, texts):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(30)] + ["É", "ñ", "Ab", "aB", "x\x0by"]
    runs = [rng.choices(words, k=rng.randrange(2, 5)) for _ in range(25)]
    out = []
    for _ in range(texts):
        parts = []
        for _ in range(rng.randrange(1, 12)):
            parts += rng.choice(runs) if rng.random() < 0.6 else [rng.choice(words)]
            parts.append(rng.choice([" ", "  ", "\t", ". ", ",", "\n", " "]))
        out.append(" ".join(parts))
    return out


@pytest.mark.parametrize(("top", "least"), [(2000, 10), (3, 4), (40, 2), (1, 1)])
def test_phrases(spark, top, least):
    rng = random.Random(top)
    texts = [(t, rng.choice(["en", "en", "de", "und", None])) for t in prose(top, 300)]
    texts += [(None, "en"), ("", None), (" \t\n", "fr"), ("one two three " * 400, "long"), *texts[:5]]
    df = spark.createDataFrame([(i, t, lang, *PAD) for i, (t, lang) in enumerate(texts)], clash("doc_id long, text string, lang string")).repartition(6)
    got = [(r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in phrases.collocations(df, top, least).collect()]
    assert sorted(got) == phrases_by_hand(texts, top, least)


def test_phrases_of_colliding_tables(spark, monkeypatch):
    monkeypatch.setattr(phrases, "SLOTS", 8)
    monkeypatch.setattr(phrases, "WORD_BITS", 64)
    texts = [(t, "en") for t in prose(9, 200)]
    df = spark.createDataFrame(texts, "text string, lang string")
    got = [(r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in phrases.collocations(df, 5, 5).collect()]
    assert sorted(got) == phrases_by_hand(texts, 5, 5)


def test_phrase_scores_pass_64_bits(spark):
    df = spark.createDataFrame([(900_000_000_000, 1_000_000_000_000, 999_999_999_999)], "a long, l long, r long")
    got = df.select(phrases._score("a", "l", "r").alias("s")).first().s
    assert got == 1000000 * 900_000_000_000**2 // (1_000_000_000_000 * 999_999_999_999)


def test_phrases_of_no_rows(spark):
    for rows in ([], [(None, None)], [("a b", "en")]):
        assert phrases.collocations(spark.createDataFrame(rows, "text string, lang string")).count() == 0


# near duplicates


def shingle_set(text, k):
    parts = [w for w in (text or "").encode().lower().split()]
    return frozenset(tuple(parts[i : i + k]) for i in range(len(parts) - k + 1)) if len(parts) >= k else frozenset([tuple(parts)] if parts else [])


def components_by_hand(rows, k, num):
    sets = {}
    for doc, text in rows:
        sets.setdefault(shingle_set(text, k), []).append(doc)
    known = [s for s in sets if s]
    root = {s: s for s in known}

    def find(s):
        while root[s] != s:
            s = root[s]
        return s

    for a, b in itertools.combinations(known, 2):
        if 100 * len(a & b) >= num * len(a | b):
            root[find(a)] = find(b)
    low = {}
    for s in known:
        low.setdefault(find(s), []).extend(d for d in sets[s] if d is not None)
    out = []
    for doc, text in rows:
        s = shingle_set(text, k)
        part = (min(low[find(s)], default=None)) if s else doc
        out.append((doc, len(s), part, doc == part))
    return sorted(out, key=repr)


def edited(text, rng, words, most):
    parts = text.split()
    for _ in range(rng.randrange(most + 1)):
        parts[rng.randrange(len(parts))] = rng.choice(words)
    return " ".join(parts)


@pytest.fixture(scope="module")
def near_rows():
    rng = random.Random(8)
    words = [f"w{i}" for i in range(900)]
    texts = [" ".join(rng.choices(words, k=rng.choice((2, 5, 9, 30, 90, 200)))) for _ in range(50)]
    out = list(texts)
    for text in texts:
        out += [edited(text, rng, words, 3) for _ in range(3)]
    hot = " ".join(rng.choices(words, k=120))  # a large group, many of it just below the threshold
    out += [edited(hot, rng, words, 6) for _ in range(120)]
    chain = hot.split()
    for i in range(40):  # each links with the next one only
        chain[i * 3] = f"c{i}"
        out.append(" ".join(chain))
    out += [None, "", " \n", texts[3].upper(), texts[3], texts[3], "long " * 3000, "é" * 40]
    rng.shuffle(out)
    return [*((i, t) for i, t in enumerate(out)), (0, out[0]), (None, texts[3]), (None, "only one here and no id at all"), (None, None)]


@pytest.mark.parametrize(("k", "num", "block"), [(5, 85, 1024), (5, 80, 16), (3, 90, 16)])
def test_near_duplicates(spark, near_rows, monkeypatch, k, num, block):
    monkeypatch.setattr(minmax, "BLOCK", block)
    df = spark.createDataFrame([(*r, *PAD) for r in near_rows], clash("doc_id long, text string")).repartition(7)
    got = sorted((tuple(r) for r in minmax.near_duplicates(df, k, num).collect()), key=repr)
    assert got == components_by_hand(near_rows, k, num)


def test_near_duplicates_of_no_rows(spark):
    assert minmax.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(2)
    off = []
    for share in (0.3, 0.6, 0.85):
        for _ in range(30):
            n = 400
            both = int(n * share)
            value = rng.integers(0, 1 << 63, 2 * n - both, dtype=np.uint64) * np.uint64(2)
            pair = np.concatenate([value[:n], value[n - both :]])
            signature = minmax.signatures(pair, np.array([0, n]))
            off.append((signature[0] == signature[1]).mean() - both / (2 * n - both))
    assert abs(np.mean(off)) < 0.01 and np.std(off) < 0.035
