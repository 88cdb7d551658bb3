"""Helper columns never meet the columns of a table; long strings; rows of one id."""

import numpy as np
import pytest

from portrisk.llm import jaccard, line_dedup, mixing, suffixes
from portrisk.llm.names import private

EXTRA = ["_id", "_copies", "_COPIES_2", "_size", "_set", "_lost", "_version", "_turn", "size", "copies", "line", "at", "root", "id"]
SCHEMA = "doc_id long, text string, source string, " + ", ".join(f"`{c}` string" for c in EXTRA)


@pytest.fixture(scope="module")
def clashing(spark):
    line = " ".join(f"w{i}" for i in range(30))
    texts = [line, f"{line}\nown words here", line, None, "", "a b", line]
    rows = [(i if i < 6 else None, t, "s", *(f"{c}{i}" for c in EXTRA)) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


def test_private_names_are_new(spark):
    df = spark.createDataFrame([], "_id int, __ID int, x int")
    assert private(df, "id", "x") == ["___id", "_x"]


def test_line_dedup_keeps_all_columns(clashing):
    out = line_dedup.dedup_lines(clashing)
    assert out.columns == [*clashing.columns, "n_lines", "n_deleted"]
    by = {r.doc_id: r for r in out.collect()}
    assert [by[i]["_id"] for i in range(6)] == [f"_id{i}" for i in range(6)]
    assert by[0].n_deleted == 0 and by[1].text == "own words here" and by[2].n_deleted == 1 and by[None].n_deleted == 0


def test_line_dedup_replaces_counts_of_the_same_name(clashing):
    out = line_dedup.dedup_lines(clashing.withColumnsRenamed({"_id": "N_LINES", "_set": "n_deleted"}))
    assert out.columns.count("n_lines") == out.columns.count("n_deleted") == 1 and "N_LINES" not in out.columns
    assert sorted(r.n_deleted for r in out.collect()) == [0, 0, 0, 0, 0, 1, 1]
    renamed = line_dedup.dedup_lines(clashing.withColumnRenamed("_id", "n_lines"), counts=("lines_now", "lines_gone"))
    assert {r.n_lines for r in renamed.collect()} == {f"_id{i}" for i in range(7)}


def test_mixing_takes_whole_rows(clashing):
    out = mixing.take(clashing)
    assert out.columns == clashing.columns
    want = {r.doc_id: r.copies for r in mixing.mix(clashing).collect()}
    got = [r.doc_id for r in out.collect()]
    assert {i: got.count(i) for i in want} == want


def test_keep_first_keeps_whole_rows(clashing):
    out = jaccard.keep_first(clashing, k=5, num=80, den=100)
    assert out.columns == clashing.columns
    kept = {r.doc_id: r["_size"] for r in out.collect()}
    assert kept == {i: f"_size{i}" for i in (0, 3, 4, 5)} or kept == {i: f"_size{i}" for i in (0, 1, 3, 4, 5)}


@pytest.mark.parametrize("length", [138, 200])
def test_suffix_dedup_of_long_strings(spark, length):
    rng = np.random.default_rng(3)
    word = lambda n: rng.integers(97, 123, n).astype(np.uint8).tobytes().decode()
    passage = word(900)
    texts = [word(300) + passage, passage[:500] + word(50), word(20) + passage[100 : 100 + length - 1], passage[300 : 300 + length], word(700)]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.n_removed for r in suffixes.dedup(rows, length=length).collect()}
    assert got == {0: 0, 1: 500, 2: 0, 3: length, 4: 0}
