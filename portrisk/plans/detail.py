"""The news detail report: the worst news of each day and route, summarised."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portrisk import profiles as P
from portrisk.functions.text import extractive_summary, slice_content
from portrisk.functions.themes import theme_flags
from portrisk.operators.filters import drop_scrape_errors, negative_only, period
from portrisk.operators.joins import attach_summary
from portrisk.operators.ranking import top_themes
from portrisk.session import freeze

NEWS_ID = ("CAMEOEVENTIDS", "SOURCEURLS")
ROUTES = ("is_ruta_transpacifica", "is_ruta_transatlantica")

# fixed values: report columns and the stored columns they show
DETAIL_COLUMNS = {
    "DATE": "Date",
    "EXTRACTION_DATE": "extraction_date",
    "COUNTRYCODE": "CountryCode",
    "LOCATIONCODE": "LocationCode",
    "AVERAGETONE": "AverageTone",
    "IS_RUTA_TRANSPACIFICA": "is_ruta_transpacifica",
    "IS_RUTA_TRANSATLANTICA": "is_ruta_transatlantica",
    "IS_RUTA_DEL_CABO_DE_BUENA_ESPERANZA": "is_ruta_del_cabo_de_buena_esperanza",
    "SOURCEURLS": "SOURCEURLS",
    "SUMMARY": "summary",
}


def detail_projection(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(source).alias(name) for name, source in DETAIL_COLUMNS.items()])


def problem_news(
    silver: DataFrame, routes: Sequence[str] = ROUTES, since: str | None = None
) -> DataFrame:
    """Negative, readable news with their risk score, once per route they are on."""
    rows = theme_flags(drop_scrape_errors(negative_only(period(silver, since))), P.RISK_THEMES)
    on = F.array_compact(F.array(*[F.when(F.col(flag) == 1, F.lit(flag)) for flag in routes]))
    return rows.withColumn("route", F.explode(on))


def summarise(news: DataFrame, k: int = 3, span: tuple[int, int] | None = None) -> DataFrame:
    """Route, day and identity of each news row with its summary.

    Whole texts are read unless a ``span`` is given. A text shared by several
    news is summarised once: texts are keyed by their digest.
    """
    if span is not None:
        news = slice_content(news, *span)
    keyed = news.withColumn("_text", F.sha2("contenturl", 256))
    texts = keyed.groupBy("_text").agg(F.first("contenturl").alias("contenturl"))
    summaries = extractive_summary(texts, k, "_text", "contenturl")
    return keyed.join(summaries, "_text").select("route", "Date", *NEWS_ID, "summary")


def news_detail_report(
    silver: DataFrame,
    routes: Sequence[str] = ROUTES,
    since: str | None = None,
    k: int = 3,
    sentences: int = 3,
    span: tuple[int, int] | None = None,
) -> DataFrame:
    """All problem news of the routes; the ``k`` highest scored of a day carry a summary.

    The routes' reports are stacked: a news row on two routes appears for both.
    Summaries are joined on the news itself, not on its rank, so a tie cannot
    hand a summary to another article. The best news are few (``k`` per day and
    route), so they are frozen before their texts are read several times over.
    """
    news = problem_news(silver, routes, since)
    best = freeze(top_themes(news, k, by=("route", "Date")))
    keys = ["route", "Date", *NEWS_ID]
    summaries = summarise(best, sentences, span).dropDuplicates(keys)
    return detail_projection(attach_summary(news.drop("contenturl"), summaries, keys))
