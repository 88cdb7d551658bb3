"""Daily feature frames for forecasting, all profiles in one job."""

from __future__ import annotations

from pyspark.sql import DataFrame

from portrisk import profiles as P
from portrisk.functions.parse import parse_locations, parse_tone, with_date
from portrisk.operators.aggregates import daily_features
from portrisk.operators.filters import (
    drop_emotional,
    drop_null_rows,
    in_locations,
    negative_only,
    port_themes_broad,
)
from portrisk.operators.joins import date_spine, densify
from portrisk.operators.stats import (
    minmax_fit,
    minmax_transform,
    split_train_test,
    winsorize,
)
from portrisk.operators.windows import difference, sliding_windows
from portrisk.session import freeze


def feature_news(raw: DataFrame) -> DataFrame:
    """Negative, unemotional port news at any profile location.

    Route flags are not needed here, so only the fields in use are parsed.
    """
    codes = list(dict.fromkeys(c for members in P.PROFILES.values() for c in members))
    parsed = in_locations(parse_tone(parse_locations(with_date(raw))), codes)
    return negative_only(port_themes_broad(drop_emotional(parsed)))


def daily_changes(daily: DataFrame) -> DataFrame:
    """Daily features with the change against the row before; first rows have none."""
    return drop_null_rows(difference(daily), ["Diff"])


def feature_frame(
    news: DataFrame,
    members: DataFrame,
    split_date: str = P.SPLIT_DATE,
    calendar: bool = False,
    fit_on: str | None = None,
) -> DataFrame:
    """The 13 daily features per profile, with the train/test split.

    The change is taken between consecutive rows; ``calendar`` first adds the
    days without news. The first day of a series has no change and is dropped.
    """
    daily = daily_features(news, members)
    if calendar:
        daily = freeze(daily)
        spine = date_spine(daily, daily.select("profile"), calendar=True)
        daily = densify(spine, daily, ["profile", "Date"])
    split = split_train_test(daily_changes(daily), split_date)
    return winsorize(split, fit_on=fit_on).select("profile", "Date", "split", *P.FEATURES)


def scaled_windows(frame: DataFrame, lags: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Scaled training windows of every profile, and the fitted scale limits.

    Without ``lags`` each profile uses its own window length.
    """
    limits = minmax_fit(frame, P.FEATURES)
    scaled = minmax_transform(frame, limits, P.FEATURES)
    lengths = lags if lags is not None else {p: P.lags_for(p) for p in P.PROFILES}
    return sliding_windows(scaled, lengths, P.FEATURES), limits
