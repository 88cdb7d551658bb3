"""Theme flags and news weights."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from portrisk import profiles as P


def has_theme(word: str, column: str = "THEMES", token: bool = False) -> Column:
    """Does the theme list mention ``word``?

    Default is a literal substring, as PORT is meant to match WB_135_PORT; with
    ``token`` the word must be a whole list entry. Null lists give null.
    """
    if token:
        return F.array_contains(F.split(F.col(column), ";"), word)
    return F.col(column).contains(word)


def _flag(word: str, token: bool) -> Column:
    return F.coalesce(has_theme(word, token=token).cast("int"), F.lit(0))


def theme_flags(
    df: DataFrame,
    themes: Mapping[str, str] = P.RISK_THEMES,
    total: str | None = "Total",
    token: bool = False,
) -> DataFrame:
    """A 0/1 column per theme and, unless ``total`` is None, their sum."""
    flags = {name: _flag(word, token) for name, word in themes.items()}
    if total:
        score = sum(flags.values(), F.lit(0))
        flags = {**flags, total: score}
    return df.withColumns(flags)


def is_port_news_broad() -> Column:
    """Any port, shipping or maritime word, and no airport."""
    words = [has_theme(w) for w in P.PORT_WORDS]
    either = words[0]
    for word in words[1:]:
        either = either | word
    return either & ~has_theme(P.EXCLUDED_WORD)


def is_port_news_strict() -> Column:
    """Port and transport together, and no airport."""
    return has_theme("PORT") & has_theme("TRANSPORT") & ~has_theme(P.EXCLUDED_WORD)


def weight(total: str = "Total", news: str = "NumberOfNews", fix_total3: bool = False) -> Column:
    """Risk weight of a group of equally scored news.

    The third branch looks at the number of news, not at the score: groups of
    exactly three news weigh 100 each. ``fix_total3`` tests the score instead.
    Branch order matters.
    """
    t, n = F.col(total), F.col(news)
    third = (t if fix_total3 else n) == 3
    return (
        F.when(t == 5, n * P.WEIGHT_TOTAL_5)
        .when(t == 4, n * P.WEIGHT_TOTAL_4)
        .when(third, n * P.WEIGHT_THREE)
        .when(t == 2, n * P.WEIGHT_TOTAL_2)
        .otherwise(F.lit(0))
    )


def weight_news(df: DataFrame, fix_total3: bool = False) -> DataFrame:
    return df.withColumn("WeightedCountOfNews", weight(fix_total3=fix_total3).cast("long"))


def fill_zero(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Null numbers become 0; strings and dates keep their nulls."""
    numeric = {"tinyint", "smallint", "int", "bigint", "float", "double"}
    chosen = columns or [c for c, t in df.dtypes if t in numeric or t.startswith("decimal")]
    return df.na.fill(0, subset=chosen) if chosen else df
