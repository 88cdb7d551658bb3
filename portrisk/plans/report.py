"""From raw news to the weighted risk report and the growth study."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portrisk import profiles as P
from portrisk.functions.parse import parse_news
from portrisk.functions.text import extract_paragraphs
from portrisk.functions.themes import (
    fill_zero,
    is_port_news_strict,
    theme_flags,
    weight,
)
from portrisk.operators.aggregates import GROWTH_KEYS, weighted_groups
from portrisk.operators.filters import (
    drop_emotional,
    in_locations,
    negative_only,
    port_themes_broad,
    port_themes_strict,
)
from portrisk.operators.joins import attach_pages, date_spine, densify
from portrisk.operators.ranking import rank_negative
from portrisk.session import freeze

REPORT_KEYS = ("Date", "Total", "LocationCode", *P.ROUTE_FLAGS)


def route_news(raw: DataFrame, routes: Mapping[str, Sequence[str]] = P.ROUTE_FLAGS) -> DataFrame:
    """Parsed port news at the locations of any of the routes."""
    codes = list(dict.fromkeys(c for members in routes.values() for c in members))
    return port_themes_broad(in_locations(parse_news(raw), codes))


def build_silver(raw: DataFrame, pages: DataFrame | None = None, k: int = 3, **options) -> DataFrame:
    """Port news with their rank by negative tone per day and place.

    The ``k`` worst of each group get the text of their page, the others keep a
    null. Only these few rows meet the page table, and pages are parsed after the
    match, so no text is extracted for nothing.
    """
    return with_worst_pages(rank_negative(route_news(raw), **options), pages, k)


def with_worst_pages(
    ranked: DataFrame, pages: DataFrame | None, k: int = 3, texts: DataFrame | None = None, keys: Sequence[str] = ()
) -> DataFrame:
    """Ranked news with the page text of the ``k`` worst of each group, null for the others.

    ``texts`` (keys, _text) are texts that were attached before; they are kept where there is one,
    and only the other rows look for a page.
    """
    missing = F.lit(None).cast("string")
    if pages is None and texts is None:
        return ranked.withColumn("contenturl", missing)
    worst, rest = ranked.where(F.col("rank") <= k), ranked.where(F.col("rank") > k).withColumn("contenturl", missing)
    if texts is None:
        return attach_pages(worst, pages, extract_paragraphs).unionByName(rest)
    one = texts.groupBy(*keys).agg(F.first("_text").alias("_text")).withColumnsRenamed({c: f"_{c}" for c in keys})
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in keys])
    known = worst.join(one, same, "left").select(*worst.columns, "_text")
    if pages is None:
        return known.withColumnRenamed("_text", "contenturl").unionByName(rest)
    kept = known.where("_text is not null").withColumnRenamed("_text", "contenturl")
    open_ = known.where("_text is null").drop("_text")
    return kept.unionByName(attach_pages(open_, pages, extract_paragraphs)).unionByName(rest)


def scored_news(news: DataFrame) -> DataFrame:
    """Unemotional, negative, strictly port-related news with their risk score."""
    return negative_only(theme_flags(port_themes_strict(drop_emotional(news)), P.RISK_THEMES))


def weighted_report(news: DataFrame, fix_total3: bool = False) -> DataFrame:
    """News and weight per day, risk score, place and route flags."""
    return weighted_groups(scored_news(news), REPORT_KEYS, fix_total3)


def theme_grid(news: DataFrame) -> DataFrame:
    """Growth study input: theme sums and weights on the complete grid.

    Dates come from all news, groups only from scored news. One aggregation
    answers both: every news row counts for its date, and the sums look at the
    scored rows alone. The result, one row per day, score and place, is frozen and
    the grid is built from it, so the news are read once.
    """
    flagged = theme_flags(news, P.RISK_THEMES)
    emotional = F.col("AverageTone").between(-P.NEUTRAL_BAND, P.NEUTRAL_BAND) & (
        F.col("Polarity") >= P.HIGH_POLARITY
    )
    scored = F.coalesce(
        ~F.coalesce(emotional, F.lit(False)) & is_port_news_strict() & (F.col("AverageTone") < 0),
        F.lit(False),
    )
    sums = ("NewsWithTINFA", "NewsWithME", "NewsWithPS", "NewsWithMI")
    counted = flagged.groupBy(*GROWTH_KEYS).agg(
        *[F.sum(F.when(scored, F.col(c)).otherwise(0)).alias(c) for c in sums],
        F.sum(F.when(scored, F.col("Total")).otherwise(0)).alias("TotalThemesFindings"),
        F.count_if(scored).alias("NumberOfNews"),
    )
    cube = freeze(counted)
    facts = cube.where(F.col("NumberOfNews") > 0).withColumn(
        "WeightedCountOfNews", weight().cast("long")
    )
    spine = date_spine(cube, facts.select("Total", "LocationCode"))
    return fill_zero(densify(spine, facts, GROWTH_KEYS))
