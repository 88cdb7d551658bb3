"""Pages, summaries and the detail report."""

from __future__ import annotations

from pyspark.sql import functions as F

from portrisk import fixtures as X
from portrisk.functions import text
from portrisk.plans.detail import news_detail_report
from portrisk.plans.report import build_silver
from portrisk.registry.base import query, risk_total
from portrisk.session import freeze

_SENTENCE = r"[.!?]+[ \t\r\n]+|[\r\n]+"
_WORD = r"""[ \t\r\n.,;:!?"''()\[\]{}<>|&%$#*/=+_-]+"""


@query("t05_extract_paragraphs", "select page_id, content from page_text", ("page_text",))
def _(spark, sf):
    return X.spread(spark, sf, "pages").select("page_id", text.extract_paragraphs("html").alias("content"))


def _summary_sql(source, key, column, k=3):
    """CTEs that end in summaries(key, summary)."""
    return (
        f"texts as (select {key} as key, string_split_regex({column}, '{_SENTENCE}') as parts from {source}), "
        "sents as (select key, unnest(range(len(parts)))::int as pos, unnest(parts) as s from texts), "
        f"toks as (select key, pos, unnest(list_filter(string_split_regex(lower(s), '{_WORD}'), lambda w: w <> '')) as word from sents), "
        "freq as (select word, count(*) as f from toks group by 1), "
        "scores as (select key, pos, sum(f)::double / count(*) as score from toks join freq using (word) group by 1, 2), "
        f"best as (select * from (select *, row_number() over (partition by key order by score desc, pos) as r from scores) where r <= {k}), "
        "summaries as (select b.key, string_agg(trim(s.s), ' ' order by b.pos) as summary from best b join sents s using (key, pos) group by 1)"
    )


@query(
    "t06_extractive_summary",
    "with " + _summary_sql("documents", "doc_id", "text") + " select key as doc_id, summary from summaries",
)
def _(spark, sf):
    return text.extractive_summary(X.spread(spark, sf, "documents"), 3)


@query(
    "t06_sentence_scores",
    "with " + _summary_sql("documents", "doc_id", "text") + " select key as doc_id, pos as position, round(score, 6) as score from scores",
)
def _(spark, sf):
    scores = text.sentence_scores(X.spread(spark, sf, "documents"))
    return scores.withColumn("score", F.round("score", 6))


_DETAIL = (
    "with problem as (select *, row_number() over (partition by route, d order by total desc, CAMEOEVENTIDS, SOURCEURLS) as r from "
    f"(select s.*, {risk_total()} as total, f.route from linked_silver s join (values ('p'), ('a')) f(route) on "
    "case f.route when 'p' then is_ruta_transpacifica else is_ruta_transatlantica end = 1 where avg_tone < 0 "
    "and contenturl not like '%Client Error%' and contenturl not like '%OK XID%')), "
    + _summary_sql("(select distinct contenturl from problem where r <= 3)", "contenturl", "contenturl")
    + ' select d as "DATE", extraction_date as "EXTRACTION_DATE", country as "COUNTRYCODE", loc as "LOCATIONCODE", '
    'avg_tone as "AVERAGETONE", is_ruta_transpacifica as "IS_RUTA_TRANSPACIFICA", is_ruta_transatlantica as '
    '"IS_RUTA_TRANSATLANTICA", is_ruta_del_cabo_de_buena_esperanza as "IS_RUTA_DEL_CABO_DE_BUENA_ESPERANZA", '
    'SOURCEURLS as "SOURCEURLS", case when r <= 3 then summary end as "SUMMARY" from problem left join summaries on key = contenturl'
)


@query("t07_news_detail_report", _DETAIL, ("linked_silver",))
def _(spark, sf):
    silver = build_silver(X.linked_gkg(spark, sf), X.spread(spark, sf, "pages"))
    return news_detail_report(freeze(silver))
