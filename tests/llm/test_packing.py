"""Packing: little padding at any length, all three limits, files whose rule is not known, forgetful caches."""

import json
import random

import numpy as np
import pytest

from portrisk.llm import packing
from portrisk.llm.queries import tokenizer_path

SCHEMA = "doc_id long, text string, head string"


def sequences(rows):
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append(r)
    return by.values()


def is_power(n):
    return n & (n - 1) == 0


@pytest.mark.parametrize("words", [0, 2, 5])
def test_tiny_texts_leave_no_padding(spark, words):
    docs = spark.createDataFrame([(i, " a" * words or None, None) for i in range(6000)], SCHEMA).coalesce(1)
    sizes = [sum(r.length for r in x) for x in sequences(packing.pack_words(docs, tokenizer_path(), tokens=512).collect())]
    assert sum(sizes) == 6000 * (words + 1) and all(n == 512 or is_power(n) and n < 512 for n in sizes)
    assert sizes.count(512) == sum(sizes) // 512


@pytest.mark.parametrize(("segments", "loss"), [(None, 64), (4, None), (6, 100)])
def test_limits_that_bind(spark, segments, loss):
    rng = random.Random(2)
    word = lambda n: " ".join(rng.choice("abcdefgh") for _ in range(n))
    docs = spark.createDataFrame([(i, word(rng.randrange(40)), word(rng.randrange(60))) for i in range(800)], SCHEMA).coalesce(2)
    rows = packing.pack_words(docs, tokenizer_path(), tokens=256, segments=segments, loss_tokens=loss, prompt="head").collect()
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
    for r in docs.collect():
        pieces = sorted(by_doc[r.doc_id], key=lambda x: x.start)
        head, total = len(r.head.split()), len(r.head.split()) + len(r.text.split()) + 1
        assert [p.start for p in pieces] == list(np.cumsum([0, *(p.length for p in pieces[:-1])])) and sum(p.length for p in pieces) == total
        for p in pieces:
            assert p.loss_tokens == sum(at >= head for at in range(p.start, p.start + p.length))
    at_limit = 0
    for x in sequences(rows):
        assert sum(r.length for r in x) <= 256 and len(x) <= (segments or 256) and sum(r.loss_tokens for r in x) <= (loss or 256)
        at_limit += sum(r.length for r in x) == 256 or len(x) == segments or sum(r.loss_tokens for r in x) == loss
    assert at_limit > 0.9 * len(sequences(rows))


def test_other_files_are_encoded_whole(tmp_path):
    told = json.load(open(tokenizer_path(), encoding="utf-8"))
    assert packing._rules(tokenizer_path())
    told["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"] = r"[\p{L}\p{N}]+(?!x)|[^\s\p{L}\p{N}]+"
    path = tmp_path / "other.json"
    path.write_text(json.dumps(told))
    other = packing.WordTokenizer(str(path))
    assert other.rules is None
    text = "ab12 it's done"
    assert other.encode(text.encode()).tolist() == other.tokenizer.encode(text, add_special_tokens=False).ids


def test_a_pattern_is_read_from_the_file(tmp_path):
    told = json.load(open(tokenizer_path(), encoding="utf-8"))
    told["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"] = r"[\p{L}\p{N}]+|[^\s\p{L}\p{N}]+"
    path = tmp_path / "other.json"
    path.write_text(json.dumps(told))
    other = packing.WordTokenizer(str(path))
    for text in ("ab12 it's done", "Ärger über 12a", "x2́ Σας", "a b ×÷"):
        assert other.rules and other.encode(text.encode()).tolist() == other.tokenizer.encode(text, add_special_tokens=False).ids


class Counted:
    def __init__(self, pattern):
        self.pattern, self.calls = pattern, 0

    def findall(self, text):
        self.calls += 1
        return self.pattern.findall(text)


def test_new_words_are_cut_together():
    words = packing.WordTokenizer(tokenizer_path())
    cut = Counted(words.rules[0])
    words.rules = (cut, *words.rules[1:])
    text = " ".join(f"word{i}'s,Éa%%" + "本" * (i % 50 == 0) + "<|endoftext|>" * (i % 70 == 0) for i in range(3000))
    assert words.encode(text.encode()).tolist() == words.tokenizer.encode(text, add_special_tokens=False).ids
    assert words.encode("本 \u1234".encode()).tolist() == words.tokenizer.encode("本 \u1234", add_special_tokens=False).ids
    assert cut.calls <= 2


@pytest.mark.parametrize("most", [1, 4, 1 << 20])
def test_words_are_their_own_keys(monkeypatch, most):
    monkeypatch.setattr(packing, "CACHE_WORDS", most)
    words = packing.WordTokenizer(tokenizer_path())
    rng = random.Random(5)
    parts = ["\x00" * n for n in (1, 7, 8, 23, 24, 25)] + ["a" * n for n in range(1, 60)] + ["a\x00", "a" * 24 + "b", "b" * 24, "é" * 12, "é" * 13]
    text = " ".join(rng.choice(parts) for _ in range(4000))
    for _ in range(2):
        assert words.encode(text.encode()).tolist() == words.tokenizer.encode(text, add_special_tokens=False).ids
    assert words.encode_all([]) == [] and [len(x) for x in words.encode_all([b"", b" ", b"a"])] == [0, 0, 1]
    assert words.words.end <= 8 << words.words.bits


def test_pieces_that_go_on_beyond_a_line(tmp_path):
    told = json.load(open(tokenizer_path(), encoding="utf-8"))
    told["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"] = r"[\p{L}]+|[^\p{L} ]+"
    path = tmp_path / "other.json"
    path.write_text(json.dumps(told))
    other = packing.WordTokenizer(str(path))
    assert other.rules and other.encode(b"a1. .2b c%% 3").tolist() == other.tokenizer.encode("a1. .2b c%% 3", add_special_tokens=False).ids


def test_small_caches_and_slices_change_nothing(monkeypatch):
    monkeypatch.setattr(packing, "CACHE_WORDS", 20)
    monkeypatch.setattr(packing, "SLICE", 50)
    tokenizer = packing.WordTokenizer(tokenizer_path())
    rng = random.Random(4)
    words = [*(f"w{i}x{i * i}." for i in range(90)), "É", "Ça", "日本語", "<|endoftext|>", "l'été", "x" * 200]
    texts = [rng.choice((" ", "\n", "  ")).join(rng.choices(words, k=rng.randrange(60))) for _ in range(60)] + ["", " "]
    for got, text in zip(tokenizer.encode_all([t.encode() for t in texts]), texts, strict=True):
        assert got.tolist() == tokenizer.tokenizer.encode(text, add_special_tokens=False).ids
