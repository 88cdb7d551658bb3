"""Grouped reports. All are partial aggregations: a hot key shrinks before the shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portrisk import profiles as P
from portrisk.functions.parse import goldstein_split
from portrisk.functions.themes import has_theme, weight_news
from portrisk.session import broadcast_if_small

GROWTH_KEYS = ("Date", "Total", "LocationCode")


def weighted_groups(
    news: DataFrame, keys: Sequence[str], fix_total3: bool = False
) -> DataFrame:
    """News per group and their risk weight; ``keys`` must include Total."""
    counted = news.groupBy(*keys).agg(F.count("Total").alias("NumberOfNews"))
    return weight_news(counted, fix_total3)


def theme_growth_base(news: DataFrame) -> DataFrame:
    """Theme sums per day, score and place (trade is scored but not summed)."""
    summed = ("NewsWithTINFA", "NewsWithME", "NewsWithPS", "NewsWithMI")
    return news.groupBy(*GROWTH_KEYS).agg(
        *[F.sum(c).alias(c) for c in summed],
        F.sum("Total").alias("TotalThemesFindings"),
        F.count("Total").alias("NumberOfNews"),
    )


def daily_weight(report: DataFrame) -> DataFrame:
    return report.groupBy("Date", "LocationCode").agg(
        F.sum("WeightedCountOfNews").alias("WeightedCountOfNews")
    )


def daily_tone(news: DataFrame, keys: Sequence[str] = ("Date",)) -> DataFrame:
    """Number of news and their tone per day."""
    return news.groupBy(*keys).agg(
        F.count("Date").alias("NegativeNews"),
        F.avg("ToneNegativeScore").alias("ToneNegativeScore"),
        F.avg("Polarity").alias("Polarity"),
        F.max("ToneNegativeScore").alias("MaxToneNeg"),
        F.min("ToneNegativeScore").alias("MinToneNeg"),
    )


def _theme_counts():
    return [
        F.count_if(has_theme(P.DISRUPTION_THEMES[flag])).alias(name)
        for flag, name in P.DISRUPTION_COUNTS.items()
    ]


def daily_theme_counts(news: DataFrame, keys: Sequence[str] = ("Date",)) -> DataFrame:
    """News per day that mention each disruption theme."""
    return news.groupBy(*keys).agg(*_theme_counts())


def daily_features(news: DataFrame, members: DataFrame | None = None) -> DataFrame:
    """Tone and theme counts per day in one pass, per profile if members are given.

    With profiles, news are first reduced to one row per place and day. Only
    those rows are copied to the profiles of the place and merged, so a place on
    three profiles does not triple the news.
    """
    keys = ("LocationCode", "Date") if members is not None else ("Date",)
    sums = news.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("NegativeNews"),
        F.sum("ToneNegativeScore").alias("_neg"),
        F.count("ToneNegativeScore").alias("_neg_n"),
        F.sum("Polarity").alias("_pol"),
        F.count("Polarity").alias("_pol_n"),
        F.max("ToneNegativeScore").alias("MaxToneNeg"),
        F.min("ToneNegativeScore").alias("MinToneNeg"),
        *_theme_counts(),
    )
    counts = list(P.DISRUPTION_COUNTS.values())
    if members is not None:
        added = ["NegativeNews", "_neg", "_neg_n", "_pol", "_pol_n", *counts]
        sums = (
            sums.join(broadcast_if_small(members), "LocationCode")
            .groupBy("profile", "Date")
            .agg(
                *[F.sum(c).alias(c) for c in added],
                F.max("MaxToneNeg").alias("MaxToneNeg"),
                F.min("MinToneNeg").alias("MinToneNeg"),
            )
        )
    mean = lambda total, n: F.coalesce(F.try_divide(F.col(total), F.col(n)), F.lit(0.0))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0.0)).alias(c)
    return sums.select(
        *(["profile"] if members is not None else []),
        "Date",
        "NegativeNews",
        mean("_neg", "_neg_n").alias("ToneNegativeScore"),
        mean("_pol", "_pol_n").alias("Polarity"),
        zero("MaxToneNeg"),
        zero("MinToneNeg"),
        *counts,
    )


def daily_goldstein(events: DataFrame) -> DataFrame:
    """Mean cooperative and conflictive scale per day, in date order."""
    return (
        goldstein_split(events)
        .groupBy("Date")
        .agg(
            F.avg("GoldsteinPositive").alias("GoldsteinPositive"),
            F.avg("GoldsteinNegative").alias("GoldsteinNegative"),
        )
        .orderBy("Date")
    )


def distinct_dates(df: DataFrame) -> DataFrame:
    return df.select("Date").distinct()


def distinct_pairs(df: DataFrame, columns: Sequence[str] = ("Total", "LocationCode")) -> DataFrame:
    return df.select(*columns).distinct()


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows"))


def row_width_audit(lines: DataFrame, separator: str = "\t") -> DataFrame:
    """How many raw lines have how many fields."""
    width = F.size(F.split(F.col("value"), F.regexp_replace(F.lit(separator), r"([^\w\s])", r"\\$1")))
    return lines.groupBy(width.alias("columns")).agg(F.count(F.lit(1)).alias("rows"))


def combine_routes(*reports: DataFrame) -> DataFrame:
    """Stack route reports; a row on two routes stays twice."""
    first, *rest = reports
    for report in rest:
        first = first.unionByName(report)
    return first
