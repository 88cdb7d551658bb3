"""The daily jobs: raw day -> bronze -> silver -> gold, each safe to repeat."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from portrisk import profiles as P
from portrisk.functions.parse import dateadded_between, with_date
from portrisk.operators.aggregates import daily_features
from portrisk.operators.filters import period, since
from portrisk.operators.joins import route_members
from portrisk.operators.ranking import rank_negative
from portrisk.operators.stats import minmax_transform
from portrisk.operators.windows import sliding_windows
from portrisk.plans.features import daily_changes, feature_frame, feature_news, scaled_windows
from portrisk.plans.forecast import fit_forecaster, next_day_news, real_units, score
from portrisk.plans.report import REPORT_KEYS, build_silver, route_news, weighted_report, with_worst_pages
from portrisk.session import freeze
from portrisk.sources.control import next_date_to_process, store_control, stored_control
from portrisk.sources.merge import exists, latest_rows, replace_days, rows_of_days, unmatched, upsert_into
from portrisk.sources.raw import DAY, read_raw, scan_range
from portrisk.sources.readers import normalise_null_strings, stamp_lineage

EVENT_KEY = ("GlobalEventID",)


def bronze_events(spark: SparkSession, raw_path: str, table_path: str, low: str, high: str | None = None) -> None:
    """Upsert the landed events of a day or range by event id.

    The table is partitioned by the day of the event. A later delivery may name
    another day; an index of the ids tells where the earlier row is, and it goes.
    In a range the latest delivery of an event counts.
    """
    rows = read_raw(spark, raw_path, low, high)
    if high not in (None, low):
        rows = latest_rows(rows, EVENT_KEY, DAY)
    upsert_into(spark, table_path, freeze(stamp_lineage(rows, F.col(DAY)).drop(DAY)), EVENT_KEY, "Day", moving=True)


def bronze_news(spark: SparkSession, raw_path: str, table_path: str, low: str, high: str | None = None) -> None:
    """Upsert the landed news of a day or range by the identity of the news row.

    Missing parts of the key are real nulls here, and two missing parts are
    equal. The table is partitioned by DATE, which is part of the key.
    """
    rows = normalise_null_strings(read_raw(spark, raw_path, low, high))
    if high not in (None, low):
        rows = latest_rows(rows, P.NEWS_KEY, DAY, null_safe=True)
    rows = freeze(stamp_lineage(rows, F.col(DAY)).drop(DAY))
    upsert_into(spark, table_path, rows, P.NEWS_KEY, "DATE", null_safe=True)


def silver_news(
    spark: SparkSession, bronze_path: str, table_path: str, low: str, high: str | None = None,
    pages: DataFrame | None = None, k: int = 3,
) -> None:
    """Add the port news of a day or range of news dates to the silver table.

    News that the table holds are left out before anything is parsed.
    Late news change the ranks of their day and place only: the stored rows of these groups and the
    new ones are ranked together, and their days are written again. Other days, and days without
    new news, are not. A row keeps the page text it has; rows that become one of the ``k`` worst get
    theirs, and rows that no longer are lose it, as if all news had come at once.
    """
    raw = dateadded_between(spark.read.parquet(bronze_path), low, high or low, "DATE")
    if not exists(spark, table_path):
        replace_days(build_silver(raw, pages, k), table_path, "Date")
        return
    keys, group = ["Date", *[c for c in P.NEWS_KEY if c != "DATE"]], ["Date", "LocationCode"]
    dated = with_date(raw)
    unknown = unmatched(dated, rows_of_days(spark, table_path, dated, "Date"), keys, null_safe=True)
    new = freeze(route_news(unknown))
    stored = rows_of_days(spark, table_path, new, "Date")
    touched = new.select(*group).distinct()
    again = stored.join(touched, group, "left_semi")
    apart = stored.join(touched, group, "left_anti")
    texts = again.where("contenturl is not null").select(*keys, F.col("contenturl").alias("_text"))
    ranked = rank_negative(again.drop("rank", "contenturl").unionByName(new))
    replace_days(apart.unionByName(with_worst_pages(ranked, pages, k, texts, keys)), table_path, "Date")


def gold_report(
    spark: SparkSession, silver_path: str, table_path: str, low: str, high: str | None = None
) -> None:
    """Refresh the weighted report of a day or range; a changed count replaces the old."""
    silver = scan_range(spark.read.parquet(silver_path), low, high or low)
    upsert_into(spark, table_path, freeze(weighted_report(silver)), REPORT_KEYS, "Date")


def train_models(
    spark: SparkSession, bronze_path: str, model_path: str, split_date: str = P.SPLIT_DATE
) -> None:
    """Fit a model per profile and store it with its scale limits, one row each."""
    news = feature_news(spark.read.parquet(bronze_path))
    frame = freeze(feature_frame(news, route_members(spark), split_date))
    windows, limits = scaled_windows(frame)
    fit_forecaster(windows).join(limits, "profile").write.mode("overwrite").parquet(model_path)


def gold_predictions(
    spark: SparkSession, bronze_path: str, model_path: str, table_path: str, today: str, days: int = 60
) -> None:
    """Forecast for ``today`` with the stored models and store its row of each profile.

    A series has a row for each day with news, so ``days`` calendar days are read to find the rows of
    the longest window and those of the row before, whose published figure is moved on to today. Later days are
    not looked at, and earlier predictions are left as they were published.
    """
    raw = period(since(spark.read.parquet(bronze_path), days, today, "DATE"), None, _day_after(today), "DATE")
    stored = spark.read.parquet(model_path)
    frame = freeze(daily_changes(daily_features(feature_news(raw), route_members(spark))))
    scaled = minmax_transform(frame, stored, P.FEATURES)
    lengths = {p: P.lags_for(p) for p in P.PROFILES}
    windows = sliding_windows(scaled, lengths, P.FEATURES, keys=("profile",))
    predicted = real_units(score(windows, stored.select("profile", "intercept", "coefficients")), stored)
    news = next_day_news(frame, predicted).where(F.col("Date") == F.lit(today).cast("date"))
    upsert_into(spark, table_path, freeze(news), ["profile", "Date"], "Date")


def _day_after(day: str) -> str:
    return str(date.fromisoformat(day) + timedelta(days=1))


def run_day(
    spark: SparkSession, control_path: str, name: str, job: Callable[[str], None], until: str | None = None
) -> list[str]:
    """Run a pipeline for each day it has not processed yet, up to ``until`` or for one day.

    The stored control table tells the next day and is advanced after the job of a day has
    succeeded; a job that fails leaves it as it was, so the day is tried again. Returns the days
    that were run. A pipeline without a control row is an error: it was not initialised.
    """
    done = []
    while True:
        row = next_date_to_process(stored_control(spark, control_path), name).first()
        if row is None:
            raise LookupError(f"no control row for {name}")
        day = str(row["next_date_to_process"])
        if done and (until is None or day > until) or until is not None and day > until:
            return done
        job(day)
        store_control(spark, control_path, name, day)
        done.append(day)
