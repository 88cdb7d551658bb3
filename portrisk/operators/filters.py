"""Row filters."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from portrisk import profiles as P
from portrisk.functions.parse import root_code
from portrisk.functions.themes import is_port_news_broad, is_port_news_strict


def in_locations(df: DataFrame, codes: Sequence[str] | str) -> DataFrame:
    """Rows at the given location codes, or at those of a named profile."""
    codes = P.PROFILES[codes] if isinstance(codes, str) else codes
    return df.where(F.col("LocationCode").isin(*codes))


def port_themes_broad(df: DataFrame) -> DataFrame:
    return df.where(is_port_news_broad())


def port_themes_strict(df: DataFrame) -> DataFrame:
    return df.where(is_port_news_strict())


def drop_emotional(
    df: DataFrame, band: float = P.NEUTRAL_BAND, polarity: float = P.HIGH_POLARITY
) -> DataFrame:
    """Drop news that read neutral on average but are strongly worded.

    Rows without a tone or polarity are kept: nothing says they are emotional.
    """
    emotional = F.col("AverageTone").between(-band, band) & (F.col("Polarity") >= polarity)
    return df.where(~F.coalesce(emotional, F.lit(False)))


def negative_only(df: DataFrame) -> DataFrame:
    return df.where(F.col("AverageTone") < 0)


def _bound(df: DataFrame, column: str, day: str | Column) -> Column:
    """A day in the column's own type: a date, or the number yyyymmdd.

    The bound is converted, not the column, so the comparison reaches the file
    scan and prunes partitions.
    """
    date = F.lit(day).cast("date") if isinstance(day, str) else day.cast("date")
    stored = df.schema[column].dataType
    return F.date_format(date, "yyyyMMdd").cast(stored) if isinstance(stored, IntegralType) else date


def period(
    df: DataFrame, low: str | None = None, high: str | None = None, column: str = "Date"
) -> DataFrame:
    """Rows with low <= day < high; either bound may be left out.

    ``column`` holds dates, or numbers such as DATE of the raw news.
    """
    if low is not None:
        df = df.where(F.col(column) >= _bound(df, column, low))
    if high is not None:
        df = df.where(F.col(column) < _bound(df, column, high))
    return df


def since(df: DataFrame, days: int, today: str | Column, column: str = "Date") -> DataFrame:
    """Rows of the last ``days`` days before ``today``, which the caller names."""
    day = F.lit(today).cast("date") if isinstance(today, str) else today
    return df.where(F.col(column) >= _bound(df, column, F.date_sub(day, days)))


def event_scope(
    df: DataFrame, countries: Iterable[str] | None = None, roots: Iterable[int] | None = None
) -> DataFrame:
    """Events in the given countries and of the given root codes."""
    if countries is not None:
        df = df.where(F.col("ActionGeo_CountryCode").isin(*countries))
    if roots is not None:
        df = df.where(root_code("EventRootCode").isin(*[f"{int(r):02d}" for r in roots]))
    return df


def drop_scrape_errors(df: DataFrame, column: str = "contenturl") -> DataFrame:
    """Rows whose page text is there and is not a fetch error."""
    for text in P.SCRAPE_ERRORS:
        df = df.where(~F.col(column).contains(text))
    return df


def on_route(df: DataFrame, flag: str) -> DataFrame:
    return df.where(F.col(flag) == 1)


def within_radius(df: DataFrame, distance: Column, km: float = P.PORT_RADIUS_KM) -> DataFrame:
    return df.where(distance <= km)


def drill_down(df: DataFrame, **equals) -> DataFrame:
    """Rows equal to every given value, e.g. ``drill_down(df, LocationCode='CA02')``."""
    for column, value in equals.items():
        df = df.where(F.col(column) == F.lit(value))
    return df


def drop_null_rows(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    return df.na.drop(subset=list(subset) if subset else None)
