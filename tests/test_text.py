"""Paragraphs, summaries and the detail report."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from portrisk.functions import text
from portrisk.plans.detail import news_detail_report
from portrisk.plans.report import build_silver
from portrisk.session import freeze
from tests.conftest import plan_of
from tests.test_parse import news


@pytest.mark.parametrize(
    "html,want",
    [
        ("<p>one</p><p class='x'>two &amp; <b>bold</b></p>", "one two & bold"),
        ("<p>open<p>next</p> outside", "open next"),
        ("<script>var t='</p><p>no';</script><!-- <p>no</p> --><style>p{}</style><P>yes</P>", "yes"),
        ("<pre>no</pre><div><p>in div</div> after", "in div"),
        ("<p>&amp;lt; &copy;</p>", "&lt; ©"),
        ("no paragraph", ""),
        ("<p>multi\nline</p>", "multi\nline"),
        (None, None),
    ],
)
def test_paragraphs(spark, html, want):
    df = spark.createDataFrame([(html,)], "html string")
    assert df.select(text.extract_paragraphs("html")).first()[0] == want


def test_slice_counts_like_zero_based_positions(spark):
    body = "".join(chr(97 + i % 26) for i in range(5000))
    got = text.slice_content(spark.createDataFrame([(body,), (body[:100],)], "contenturl string")).collect()
    assert got[0].contenturl == body[200:3500] and got[1].contenturl == ""


DOCS = [
    (1, "Port strike today. The port is closed! Weather was fine.\nPort port port."),
    (2, "port"),
    (3, ""),
    (4, "!!! ... \n\n"),
    (5, None),
    (6, " ".join(f"w{i} common." for i in range(50))),
]


def brute_summary(k):
    import re
    from collections import Counter

    split = lambda t: re.split(r"[.!?]+[ \t\r\n]+|[\r\n]+", t)
    words = lambda s: [w for w in re.split(r"""[ \t\r\n.,;:!?"'()\[\]{}<>|&%$#*/=+_-]+""", s.lower()) if w]
    docs = {i: split(t) for i, t in DOCS if t is not None}
    count = Counter(w for parts in docs.values() for s in parts for w in words(s))
    out = {}
    for i, parts in docs.items():
        scored = [(-sum(count[w] for w in words(s)) / len(words(s)), p) for p, s in enumerate(parts) if words(s)]
        best = sorted(p for _, p in sorted(scored)[:k])
        if best:
            out[i] = " ".join(parts[p].strip(" ") for p in best)
    return out


@pytest.mark.parametrize("share", [1000, 10, 1])
def test_summary_equals_brute_force(spark, monkeypatch, share):
    """With all words heavy, some of them and none."""
    monkeypatch.setattr(text, "HEAVY_SHARE", share)
    df = spark.createDataFrame(DOCS, "doc_id int, text string")
    got = {r.doc_id: r.summary for r in text.extractive_summary(df, 2).collect()}
    assert got == brute_summary(2)


def test_words_of_texts_stay_where_they_are(spark, monkeypatch):
    """Only the list of words is stored, and one row per sentence and task is shuffled."""
    stored = []
    monkeypatch.setattr(text, "freeze", lambda df: stored.append(df.columns) or freeze(df))
    df = spark.createDataFrame(DOCS, "doc_id int, text string")
    plan = plan_of(text.sentence_scores(df))
    assert stored == [["word", "frequency"]]
    assert plan.count("Exchange hashpartitioning") == 1 and "BroadcastHashJoin" in plan


def _silver(spark):
    rows = [
        {"TONE": f"-{i}.0,1,{i}.0,4", "CAMEOEVENTIDS": str(i), "SOURCEURLS": f"u{i}<UDIV>other", "DATE": 20240101 + i % 2,
         "LOCATIONS": f"4#P#CA#{'CA10' if i % 2 else 'CA02'}#"}
        for i in range(1, 13)
    ]
    pages = spark.createDataFrame(
        [(f"u{i}", f"<p>Port {i} closed. Second sentence {i}. Third.</p>") for i in range(1, 12)] + [("u12", "<p>404 Client Error</p>")],
        "url string, html string",
    )
    keep = news(spark, *rows).withColumn("extraction_date", F.lit(dt.date(2024, 1, 2)))
    return build_silver(keep, pages)


def test_only_the_worst_news_get_their_page(spark):
    silver = _silver(spark)
    got = {r.CAMEOEVENTIDS: (r["rank"], r.contenturl) for r in silver.collect()}
    assert len(got) == 12
    assert got["10"] == (2, "Port 10 closed. Second sentence 10. Third.")
    assert got["12"] == (1, "404 Client Error")
    assert got["2"] == (6, None) and got["11"][0] == 1
    assert "Python" not in plan_of(silver)


def test_detail_report(spark):
    report = news_detail_report(_silver(spark), sentences=1)
    got = report.collect()
    assert report.columns == [
        "DATE", "EXTRACTION_DATE", "COUNTRYCODE", "LOCATIONCODE", "AVERAGETONE", "IS_RUTA_TRANSPACIFICA",
        "IS_RUTA_TRANSATLANTICA", "IS_RUTA_DEL_CABO_DE_BUENA_ESPERANZA", "SOURCEURLS", "SUMMARY",
    ]
    # two readable rows at CA02 (the third is a fetch error), three at CA10 on both routes
    assert len(got) == 2 + 3 * 2
    assert all(r.SUMMARY and r.SUMMARY.count(".") <= 1 for r in got)


def test_a_slice_can_limit_the_summarised_text(spark):
    report = news_detail_report(_silver(spark), span=(0, 6))
    assert {r.SUMMARY for r in report.collect()} == {"Port 8", "Port 7", "Port 9", "Port 1"}


def test_daily_jobs_can_be_repeated(spark, rows):
    from portrisk.plans import daily
    from portrisk.session import new_folder
    from portrisk.sources.raw import land_raw

    raw, bronze, silver, gold = (new_folder(spark, n) for n in ("raw", "bronze", "silver", "gold"))
    feed = news(spark, {"CAMEOEVENTIDS": "1"}, {"CAMEOEVENTIDS": "2", "THEMES": "PORT;TRANSPORT;TRADE;"})
    feed = feed.withColumns({c: F.lit("nan") for c in ("PERSONS", "ORGANIZATIONS", "SOURCES", "COUNTS")})
    land_raw(feed, raw, "2024-01-02")
    for _ in range(2):
        daily.bronze_news(spark, raw, bronze, "2024-01-02")
        daily.silver_news(spark, bronze, silver, "2024-01-01")
        daily.gold_report(spark, silver, gold, "2024-01-01")
    assert spark.read.parquet(bronze).count() == 2 and spark.read.parquet(silver).count() == 2
    assert rows(spark.read.parquet(gold), "Total", "NumberOfNews") == [(0, 1), (1, 1)]
    # silver opens only the partitions of its news dates
    from portrisk.functions.parse import dateadded_between

    day = dateadded_between(spark.read.parquet(bronze), "2024-01-01", "2024-01-01", "DATE")
    assert "PartitionFilters: [isnotnull(DATE" in plan_of(day)
    # a later delivery changes a count: the old row is replaced, not doubled
    more = feed.where("CAMEOEVENTIDS = '1'").withColumn("CAMEOEVENTIDS", F.lit("3"))
    land_raw(feed.unionByName(more), raw, "2024-01-02")
    daily.bronze_news(spark, raw, bronze, "2024-01-02")
    daily.silver_news(spark, bronze, silver, "2024-01-01")
    daily.gold_report(spark, silver, gold, "2024-01-01")
    assert rows(spark.read.parquet(gold), "Total", "NumberOfNews") == [(0, 2), (1, 1)]


def test_a_page_stored_twice_leaves_one_news_row(spark):
    from portrisk.functions.text import extract_paragraphs
    from portrisk.operators.joins import attach_pages

    news = spark.createDataFrame([("u", 1), ("v", 2), (None, 3)], "SOURCEURLS string, id int")
    pages = spark.createDataFrame([("u", "<p>a</p>"), ("u", "<p>b</p>"), ("u", None), (None, "<p>c</p>")], "url string, html string")
    got = sorted((r.id, r.contenturl) for r in attach_pages(news, pages, extract_paragraphs).collect())
    assert got[0] == (1, "b") and got[1:] == [(2, None), (3, None)]
