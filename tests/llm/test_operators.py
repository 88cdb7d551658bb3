"""Operators on small tables with nulls, empty and repeated rows, against brute force."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from portrisk.llm import extraction, fingerprints, jaccard, line_dedup, mixing, packing, quality, suffixes, textkit, topk, toxicity
from portrisk.llm.queries import tokenizer_path

SCHEMA = "doc_id long, text string, source string, at int, first string"


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    base = [" ".join(rng.choices(words, k=rng.choice((3, 8, 13, 40, 120)))) for _ in range(60)]
    out = list(base)
    for text in base:  # near copies, with a few words changed
        for _ in range(rng.randrange(3)):
            parts = text.split()
            for _ in range(rng.randrange(3)):
                parts[rng.randrange(len(parts))] = rng.choice(words)
            out.append(" ".join(parts))
    return out + [None, "", " \n\t", base[0], base[0].upper(), "é" * 300, "a b c", "A  b\nc"]


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, f"s{i % 3}" if i % 7 else None, 1, "x") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows + [rows[0]], SCHEMA).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def shingle_set(text, k=4):
    parts = [w.decode() for w in (text or "").encode().lower().split()]
    return {tuple(parts[i : i + k]) for i in range(len(parts) - k + 1)} if len(parts) >= k else ({tuple(parts)} if parts else set())


@pytest.mark.parametrize(("k", "num"), [(4, 85), (5, 80), (2, 50)])
def test_jaccard_components(docs, texts, k, num):
    sets = [shingle_set(t, k) for t in texts]
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(sets)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= num * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    got = {(r.doc_id, r.n_shingles, r.component_id) for r in jaccard.jaccard_join(docs, k, num).collect()}
    assert got == {(i, len(s), find(i)) for i, s in enumerate(sets)}


def test_keep_first_keeps_texts_without_id(spark):
    text = " ".join(f"w{i}" for i in range(60))
    near, other, lone = text + " x", text.replace("w", "v"), text.replace("w", "u")
    rows = [(3, text), (5, near), (None, near), (None, other), (None, other), (None, other + " y"), (None, lone), (7, "a b"), (None, None), (None, " "), (8, ""), (9, None)]
    got = jaccard.keep_first(spark.createDataFrame([(*r, "s") for r in rows], "doc_id long, text string, source string")).collect()
    others = [r.text for r in got if r.doc_id is None and r.text and r.text.startswith("v")]
    assert len(others) == 1 and others[0] in (other, other + " y")
    left = [(r.doc_id, r.text) for r in got if r.text not in others]
    assert sorted(left, key=repr) == sorted([(3, text), (None, lone), (7, "a b"), (None, None), (None, " "), (8, ""), (9, None)], key=repr)
    assert {r.source for r in got} == {"s"}
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert jaccard.keep_first(empty).count() == 0


def test_linked_sets_share_a_cell():
    rng = np.random.default_rng(3)
    reach = jaccard.Reach(85, 100)
    for n in (6, 12, 13, 14, 40, 350, 2000):
        for _ in range(40):
            a = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
            b = a.copy()
            while True:
                c = np.unique(np.append(b[1:] if rng.random() < 0.5 else b, rng.integers(0, 1 << 63, 1).astype(np.uint64)))
                both = len(np.intersect1d(a, c))
                if 100 * both < 85 * (len(a) + len(c) - both):
                    break
                b = c
            common = np.zeros(jaccard.SKETCH, bool)
            common[: jaccard.SKETCH // 2] = True
            doc = np.repeat([0, 1], [len(a), len(b)])
            which, cell = jaccard.cells(doc, np.concatenate([a, b]), 2, reach, common)
            assert np.array_equal(a, b) or set(cell[which == 0].tolist()) & set(cell[which == 1].tolist())


def brute_removed(rows, length=50):
    first = {}
    for doc, text in sorted(rows):
        for i in range(len(text) - length + 1):
            first.setdefault(text[i : i + length], doc)
    for doc, text in rows:
        gone = np.zeros(len(text), bool)
        for i in range(len(text) - length + 1):
            if first[text[i : i + length]] < doc:
                gone[i : i + length] = True
        yield doc, gone


@pytest.mark.parametrize("hot", [20_000, 2])
def test_suffix_dedup(docs, texts, hot):
    rows = [(i, (t or "").encode()) for i, t in enumerate(texts)]
    got = {r.doc_id: r for r in suffixes.dedup(docs, hot_docs=hot).collect()}
    for (doc, gone), (_, text) in zip(brute_removed(rows), rows, strict=True):
        kept = bytes(b for b, g in zip(text, gone, strict=True) if not g)
        spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
        assert (got[doc].n_bytes, got[doc].n_removed, got[doc].n_spans) == (len(text), gone.sum(), spans)
        assert got[doc].kept_sha256 == hashlib.sha256(kept).hexdigest()


def test_suffix_anchors_spread_over_parts():
    rng = np.random.default_rng(7)
    data = rng.integers(97, 123, 200_000).astype(np.uint8)
    _, _, value, _, _ = suffixes.anchors(data, np.array([0, len(data)]))
    buckets = suffixes.Buckets(128 << 20)
    held = np.bincount(buckets.of(value), minlength=buckets.n)
    assert buckets.n == 16 and held.max() < 1.5 * held.mean()


def test_known_spans_spread_over_shards(spark):
    text = " ".join(f"word{i}" for i in range(40))
    rows = spark.createDataFrame([(i, text) for i in range(16)], "doc_id long, text string").repartitionByRange(8, "doc_id")
    buckets = suffixes.Buckets(1 << 20)
    filters = spark.sparkContext.broadcast(suffixes._seen_in(rows, buckets, 50, 20, 20_000))
    known = suffixes._strings(rows, filters, buckets, 8, 50, 20).where("shard < 0")
    assert known.select("shard").distinct().count() == known.count() > 4


def test_suffix_array_is_sorted():
    rng = np.random.default_rng(1)
    for _ in range(100):
        text = rng.integers(1, 4, int(rng.integers(1, 50))).astype(np.uint16)
        assert suffixes.suffix_array(text, 100).tolist() == sorted(range(len(text)), key=lambda i: list(text[i:]))


def test_line_dedup(spark):
    long, short = " ".join("abcdefghijklmnopqrstu"), "one two"
    rows = [(1, f"{long}\n{short}"), (2, f"{short}\n\n{long}"), (3, None), (4, ""), (None, long), (5, f"x\n{long} z"), (2, f"{short}\n\n{long}")]
    ten = "\n".join(f"line {i} has words" for i in range(6))
    rows += [(6, f"{ten}\nend"), (7, f"start\n{ten}")]
    got = sorted(map(tuple, line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=repr)
    want = [(1, f"{long}\n{short}", 2, 0), *[(2, f"{short}\n", 3, 1)] * 2, (3, None, 0, 0), (4, "", 1, 0), (None, long, 1, 0), (5, f"x\n{long} z", 2, 0)]
    assert got == sorted([*want, (6, f"{ten}\nend", 7, 0), (7, "start", 7, 6)], key=repr)


def test_quality(spark, docs):
    rng = random.Random(1)
    good = [" ".join(rng.choices(["the", "of", "and", "sea", "ship"], k=30)) for _ in range(80)]
    bad = [" ".join(w.upper() + "!!" for w in t.split()) for t in good]
    table = spark.createDataFrame(list(enumerate(good + bad)), "doc_id long, text string")
    grades = spark.createDataFrame([(i, 2 if i < 80 else 0) for i in range(0, 160, 2)], "doc_id long, grade int")
    model = quality.train(table, grades)
    assert np.all(np.diff(model.thresholds) > 0)
    got = {r.doc_id: r for r in quality.score(table, model).collect()}
    assert all(got[i].keep == (i < 80) for i in range(160))
    assert quality.score(docs, model).count() == docs.count()
    assert quality.keep_good(table, grades).columns == table.columns


def test_extraction(spark):
    page = '<html><header>Site</header><div class="sidebar">x</div><nav><a>m</a></nav><article><h1>T&eacute;st {0}</h1><p>One <b>two {0}<br><p>Four</article><form>q</form><footer>f'
    rows = [(i, "http://a.b/c", page.format(i)) for i in range(5)] + [(9, None, None), (10, "", ""), (11, "http://z/", "plain &amp; text")]
    got = {r.page_id: r for r in extraction.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[3].text == "Tést 3 One two 3 Four" and got[3].n_chars == len(got[3].text)
    assert (got[9].text, got[10].text, got[11].text) == ("", "", "plain & text")
    fixed = [(i, "http://h/", f"<div><p>Subscribe to us</p></div><section><p>story number {i} here</p></section>") for i in range(6)]
    texts = {r.text for r in extraction.extract(spark.createDataFrame(fixed, "page_id long, url string, html string")).collect()}
    assert texts == {f"story number {i} here" for i in range(6)}
    a, b = ["r", [["x", [], 0], ["y", [], 1]], 2], ["r", [["y", [], 1], ["z", [], 0]], 2]
    assert extraction.match(a, b) == 2


@pytest.mark.parametrize(
    ("html", "text"),
    [
        ('<article class="post category-legal"><p>Long text</p></article>', "Long text"),
        ('<div class="layout has-sidebar"><p>Long text</p><div class="sidebar">side</div></div>', "Long text"),
        ('<div id="page" class="with-sidebar"><p>Long text</p></div><div class="related-posts">x</div>', "Long text"),
        ('<div class="post legal"><p>Long text</p></div><div id="commentary">More</div>', "Long text More"),
        ('<div class="sidebar"><article><p>Long text</p></article></div><p>More</p>', "Long text More"),
        ('<div class="widget"><main><p>Long text</p></main></div><article>More</article>', "Long text More"),
        ('<div class="article-teaser"><p>Card</p></div><p>Long text</p>', "Card Long text"),
        ('<p>Long text</p><ul><li><a href="/1">A book</a></li><li><a href="/2">A paper</a></li></ul>', "Long text A book A paper"),
        ('<div class="notice"><p>Long text</p></div><nav>m</nav>', "Long text"),
        ('<article><p>Long text</p></article><div id="comments"><article class="comment-body">Me</article></div><div class="ad">x</div>', "Long text"),
        ('<div class="site-nav">m</div><div class="share-buttons">s</div><div class="cookie_notice">c</div><p>Long text</p>', "Long text"),
    ],
)
def test_only_boilerplate_goes(html, text):
    assert extraction.main_text(f"<html><body>{html}<footer>f</footer></body></html>") == text


@pytest.mark.parametrize("first", [None, "", "<h1>Error 404</h1>", "<table><tr><td>other</table>"])
def test_template_is_found_whatever_the_first_page(spark, first):
    page = "<div><p>Read us daily</p></div><section><p>story number {0} here</p></section>"
    second = "<section><p>tale number {0} there</p></section><center>Printed at night</center>"
    rows = [(0, first)] + [(i, page.format(i)) for i in range(1, 9)] + [(i, second.format(i)) for i in range(9, 14)]
    got = {r.page_id: r.text for r in extraction.extract(spark.createDataFrame([(i, "http://h/", h) for i, h in rows], "page_id long, url string, html string")).collect()}
    assert got.pop(0) == ("" if not first else "Error 404" if "404" in first else "other")
    assert got == {i: f"story number {i} here" if i < 9 else f"tale number {i} there" for i in range(1, 14)}


@pytest.mark.parametrize("tag", ["div", "span", "font", "article", "ul><li"])
def test_pages_without_end_tags(spark, tag):
    deep = "".join(f"<{tag}>t{i} " for i in range(6000))
    rows = [(i, "http://h/", f"<div><p>Read us daily</p></div><section>{deep} number {i}") for i in range(4)]
    got = {r.page_id: r.text for r in extraction.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {i: " ".join([f"t{n}" for n in range(6000)]) + f" number {i}" for i in range(4)}


def test_packing_is_an_exact_round_trip(docs, texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    rows = packing.pack_words(docs.repartition(2), tokenizer_path(), tokens=256, segments=8).collect()
    ids = {i: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1] for i, t in enumerate(texts)}
    copies = {i: 2 if i == 0 else 1 for i in ids}
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
        part = np.array(ids[r.doc_id][r.start : r.start + r.length], "<u4")
        assert r.ids_crc32 == zlib.crc32(part.tobytes()) and r.doc_tokens == len(ids[r.doc_id])
    assert {d: sum(r.length for r in x) for d, x in by_doc.items()} == {d: len(x) * copies[d] for d, x in ids.items()}
    for x in by_sequence.values():
        x.sort(key=lambda r: r.offset)
        assert [r.offset for r in x] == [sum(r.length for r in x[:i]) for i in range(len(x))]
        assert sum(r.length for r in x) <= 256 and len(x) <= 8


def test_pieces_give_the_ids_of_whole_texts():
    from tokenizers import Tokenizer

    tokenizer, mine = Tokenizer.from_file(tokenizer_path()), packing.word_tokenizer(tokenizer_path())
    rng = random.Random(9)
    odd = ["don't", "I'LL", ".'s", "''re", "<|endoftext|>", "a<|startoftext|>b", "É", "e\u0301", "x\x01y", "\x1c", "\x7f", "12ab3", "\u00a0", "\u3000z", "\u0301", "Σας", "İ", "\x85", "<", "|", "ab", "-'D"]
    for _ in range(3000):
        text = "".join(rng.choice(odd) + rng.choice(("", "", " ", "\n", "\x0b")) for _ in range(rng.randrange(8)))
        assert mine.encode(text.encode()).tolist() == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


def test_top_k(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(v) for v in rng.integers(-3, 4, 8)]) for i in range(300)] + [(300, None), (301, [float("nan")] * 8), (302, [1.0, None] * 4), (303, [])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").where(topk.usable(F.col("embedding")))
    table = table.select("vec_id", topk.integers(F.col("embedding"), 1).alias("embedding"))
    got = {}
    for r in topk.top_k(table, table.where("vec_id % 50 = 0"), k=5).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    m = np.array([v for _, v in rows[:300]])
    for q in range(0, 300, 50):
        s = m @ m[q]
        best = sorted((-int(s[i]), i) for i in range(300) if i != q)[:5]
        assert sorted(got[q]) == [(n + 1, i, -x) for n, (x, i) in enumerate(best)]
    assert topk.top_k(table.limit(0), table.limit(0)).count() == 0


def test_toxicity(spark, docs):
    rng = random.Random(4)
    calm = [" ".join(rng.choices(["the", "port", "calm", "sea", "wind"], k=25)) for _ in range(200)]
    rude = [t + " you idiot, stupid moron!" for t in calm]
    table = spark.createDataFrame([*enumerate(calm + rude), (900, None), (901, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i >= 200)) for i in range(400)], "doc_id long, toxic int")
    got = toxicity.toxicity(table, labels).collect()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) and r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    assert len(got) == 402 and all(r.predicted == int(200 <= r.doc_id < 400) for r in got)
    assert toxicity.toxicity(docs, labels.limit(0)).count() == docs.count()


def test_fingerprints(spark):
    rng = random.Random(8)
    texts = ["".join(rng.choices("abcdé ", k=n)) for n in (0, 3, 90, 400, 400)] + [None]
    texts[4] = texts[3]
    rows = list(enumerate(texts))
    got = {r.doc_id: r for r in fingerprints.edited_fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, text in rows:
        text, after = text or "", texts[(i + 1) % len(texts)] or ""
        cut = len(text) // 4
        edited = text[: len(text) - cut] + after[:cut]
        assert (got[i].n_chars, got[i].edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
    assert got[3].fingerprint == got[4].fingerprint and got[3].near_next == 1 and got[0].fingerprint == ""
    a, b = "x" * 5 + texts[3][:60], "yy" + texts[3][:60]  # a shared run of w + k - 1
    assert {int(v) >> 32 for v in fingerprints.winnow(a)} & {int(v) >> 32 for v in fingerprints.winnow(b)}


def test_mixing(docs):
    rows = mixing.mix(docs).collect()
    by = {}
    for r in rows:
        assert 0 <= r.taken <= 3 * r.size
        by.setdefault(r.source, []).append(r)
    for x in by.values():
        assert abs(sum(r.taken for r in x) - x[0].target) <= max(r.size for r in x)
    assert mixing.take(docs).columns == docs.columns


def test_empty_tables(empty, spark):
    assert jaccard.jaccard_join(empty).count() == 0
    assert suffixes.dedup(empty).count() == 0
    assert line_dedup.dedup_lines(empty).count() == 0
    assert mixing.mix(empty).count() == 0
    assert fingerprints.edited_fingerprints(empty).count() == 0
    assert packing.pack_words(empty, tokenizer_path()).count() == 0
    labels = spark.createDataFrame([], "doc_id long, toxic int, grade int")
    assert toxicity.toxicity(empty, labels).count() == 0
    assert quality.score(empty, quality.train(empty, labels)).count() == 0
    assert extraction.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_words_are_split_at_ascii_white_space():
    data = "a b \x1fc\tD".encode()
    starts, ends, _ = textkit.words(np.frombuffer(data, np.uint8), np.array([0, len(data)]))
    assert [data[a:b] for a, b in zip(starts, ends, strict=True)] == data.split()
