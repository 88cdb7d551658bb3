"""Fields packed into strings: dates, first location block, tone numbers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from portrisk import profiles as P


def int_date(column: str | Column) -> Column:
    """yyyymmdd as a number -> DATE; an impossible date is null."""
    column = F.col(column) if isinstance(column, str) else column
    return F.try_to_date(column.cast("string"), "yyyyMMdd")


def with_date(df: DataFrame) -> DataFrame:
    """Replace the numeric DATE by a typed Date column."""
    others = [F.col(f"`{c}`") for c in df.columns if c != "DATE"]
    return df.select(int_date("DATE").alias("Date"), *others)


def _piece(column: str, separator: str, index: int) -> Column:
    # The limit stops splitting after the piece we need: location strings are long.
    return F.get(F.split(F.col(column), separator, index + 2), F.lit(index))


def parse_locations(df: DataFrame) -> DataFrame:
    """Country and first-order division of the first location block; null if absent."""
    return df.withColumns(
        {"CountryCode": _piece("LOCATIONS", "#", 2), "LocationCode": _piece("LOCATIONS", "#", 3)}
    )


def parse_tone(df: DataFrame) -> DataFrame:
    """The four leading tone numbers as doubles; malformed text is null."""
    names = ("AverageTone", "TonePositiveScore", "ToneNegativeScore", "Polarity")
    return df.withColumns(
        {n: _piece("TONE", ",", i).try_cast("double") for i, n in enumerate(names)}
    )


def route_flags(df: DataFrame, routes: Mapping[str, Sequence[str]] = P.ROUTE_FLAGS) -> DataFrame:
    """One 0/1 column per route; a location may be on several routes."""
    def flag(codes):
        if not codes:
            return F.lit(0)
        return F.when(F.col("LocationCode").isin(*codes), 1).otherwise(0)

    return df.withColumns({name: flag(codes) for name, codes in routes.items()})


def parse_news(df: DataFrame) -> DataFrame:
    """Raw news rows, or those of ``with_date``, with typed date, places, tone and route flags (one projection)."""
    dated = with_date(df) if "DATE" in df.columns else df
    return route_flags(parse_tone(parse_locations(dated)))


def first_url(column: str = "SOURCEURLS") -> Column:
    """The field may list several addresses; pages are matched on the first."""
    return F.substring_index(F.col(column), P.URL_SEPARATOR, 1)


def dateadded_between(df: DataFrame, low: str, high: str, column: str = "DATEADDED") -> DataFrame:
    """Inclusive date range on a yyyymmdd number.

    The bounds are turned into numbers, not the column into dates, so the
    comparison reaches the file scan.
    """
    as_int = lambda day: int(day.replace("-", ""))
    return df.where(F.col(column).between(as_int(low), as_int(high)))


def week_keys(df: DataFrame) -> DataFrame:
    """ISO week number, and month and week run together without padding."""
    week = F.weekofyear("Date")
    return df.withColumns(
        {
            "YearWeek": week,
            "MonthYearWeek": F.concat(F.col("MonthYear").cast("string"), week.cast("string")),
        }
    )


def goldstein_split(df: DataFrame) -> DataFrame:
    """Cooperative and conflictive parts of the event scale; the other part is 0."""
    scale = F.col("GoldsteinScale")
    return df.withColumns(
        {
            "GoldsteinPositive": F.when(scale > 0, scale).otherwise(F.lit(0.0)),
            "GoldsteinNegative": F.when(scale < 0, scale).otherwise(F.lit(0.0)),
        }
    )


def root_code(column: str | Column) -> Column:
    """Event root codes as two-digit text, however the feed delivered them."""
    column = F.col(column) if isinstance(column, str) else column
    return F.lpad(F.trim(column.cast("string")), 2, "0")
