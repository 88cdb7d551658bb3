"""Readers, raw days, merges and control rows."""

from __future__ import annotations

import io
import zipfile

import pandas as pd
from pyspark.sql import functions as F

from portrisk import fixtures as X
from portrisk import profiles as P
from portrisk import schemas
from portrisk.operators.aggregates import row_width_audit
from portrisk.registry.base import query
from portrisk.session import new_folder
from portrisk.sources import control, merge, raw, readers, tables
from portrisk.streaming.ingest import incremental_ingest

_DAY = "2024-01-15"
_EVENT_COLUMNS = (
    "GlobalEventID", "Day", "EventRootCode", "ActionGeo_CountryCode", "GoldsteinScale",
    "ActionGeo_Lat", "ActionGeo_Long", "DATEADDED", "SOURCEURL",
)
_GKG_COLUMNS = tuple(schemas.GKG.names)


def _wide_events(spark, sf):
    """Test events in the full feed layout; columns the fixture lacks are empty."""
    events = X.geo_events(spark, sf)
    have = set(events.columns)
    return events.select(
        *[
            (F.col(f.name).cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in schemas.EVENTS.fields
        ]
    )


def _write_tsv(df, folder):
    # an empty field and a missing one are written alike, as in the feeds
    df.write.options(sep="\t", quote="", escapeQuotes=False, emptyValue="").csv(folder)
    return folder


_EVENTS_SQL = (
    "select GlobalEventID, Day, EventRootCode, ActionGeo_CountryCode, "
    "round(GoldsteinScale, 3) as GoldsteinScale, round(ActionGeo_Lat, 3) as ActionGeo_Lat, "
    "round(ActionGeo_Long, 3) as ActionGeo_Long, DATEADDED, SOURCEURL from geo"
)


def _event_values(df):
    # stored as float: compare at the precision of the feed
    return df.select(
        *[
            F.round(F.col(c).cast("double"), 3).alias(c) if t == "float" else F.col(c)
            for c, t in df.select(*_EVENT_COLUMNS).dtypes
        ]
    )


@query("a01_read_events_tsv", _EVENTS_SQL, ("geo",))
def _(spark, sf):
    folder = _write_tsv(_wide_events(spark, sf), new_folder(spark, "events-tsv"))
    return _event_values(readers.read_events_tsv(spark, folder))


_GKG_SQL = (
    "select DATE, NUMARTS, nullif(COUNTS, '') as COUNTS, THEMES, LOCATIONS, PERSONS, ORGANIZATIONS, "
    "TONE, CAMEOEVENTIDS, SOURCES, SOURCEURLS from gkg"
)


@query("a02_read_gkg_tsv", _GKG_SQL, ("gkg",))
def _(spark, sf):
    folder = _write_tsv(X.gkg(spark, sf).select(*_GKG_COLUMNS), new_folder(spark, "gkg-tsv"))
    return readers.read_gkg_tsv(spark, folder)


def _zip_batches(batches):
    """One archive per Arrow batch of lines."""
    for i, batch in enumerate(batches):
        blob = io.BytesIO()
        with zipfile.ZipFile(blob, "w", zipfile.ZIP_DEFLATED) as archive:
            archive.writestr("part.csv", "\n".join(batch["value"]) + "\n")
        yield pd.DataFrame({"path": [f"part-{i}.zip"], "content": [blob.getvalue()]})


@query("a03_read_zipped_tsv", _GKG_SQL, ("gkg",))
def _(spark, sf):
    lines = X.gkg(spark, sf).select(
        F.concat_ws("\t", *[F.col(c).cast("string") for c in _GKG_COLUMNS]).alias("value")
    )
    archives = lines.mapInPandas(_zip_batches, "path string, content binary")
    return readers.parse_lines(readers.unzip_lines(archives), schemas.GKG)


_LINE = {
    "spark": "concat(cast(event_id as string), '\t', event_type, case when user_id % 7 = 0 then '\tx' "
    "else '' end, case when user_id % 11 = 0 then '\ty\tz' else '' end)",
    "duck": "concat(cast(event_id as varchar), chr(9), event_type, case when user_id % 7 = 0 then concat(chr(9), 'x') "
    "else '' end, case when user_id % 11 = 0 then concat(chr(9), 'y', chr(9), 'z') else '' end)",
}


@query(
    "a04_row_width_audit",
    f"select len(string_split({_LINE['duck']}, chr(9)))::int as columns, count(*) as rows from events group by 1",
)
def _(spark, sf):
    return row_width_audit(X.read(spark, sf, "events").selectExpr(f"{_LINE['spark']} as value"))


_MESSY = (
    "case when user_id % 5 = 0 then 'n/a' when user_id % 5 = 1 then concat(cast(user_id as {t}), '.0') "
    "when user_id % 5 = 2 then concat(' ', cast(user_id as {t})) when user_id % 5 = 3 then '' "
    "else cast(user_id as {t}) end"
)


@query(
    "a05_coerce_types",
    "select GlobalEventID, coalesce(try_cast(trim(m) as bigint), trunc(try_cast(trim(m) as double))::bigint)::int as NumMentions, "
    "try_cast(trim(m) as double) as AvgTone, m as Actor1Name "
    f"from (select event_id as GlobalEventID, {_MESSY.format(t='varchar')} as m from events)",
)
def _(spark, sf):
    messy = X.read(spark, sf, "events").selectExpr(
        "cast(event_id as string) as GlobalEventID", f"{_MESSY.format(t='string')} as m"
    )
    text = messy.select("GlobalEventID", F.col("m").alias("NumMentions"), F.col("m").alias("AvgTone"), F.col("m").alias("Actor1Name"))
    return readers.coerce_types(text, schemas.EVENTS).withColumn("AvgTone", F.col("AvgTone").cast("double"))


@query(
    "a06_normalise_null_strings",
    "select CAMEOEVENTIDS, nullif(trim(THEMES), 'nan') as THEMES, nullif(trim(LOCATIONS), 'nan') as LOCATIONS, "
    "nullif(trim(PERSONS), 'nan') as PERSONS from gkg",
    ("gkg",),
)
def _(spark, sf):
    rows = X.gkg(spark, sf).select("CAMEOEVENTIDS", "THEMES", "LOCATIONS", "PERSONS")
    return readers.normalise_null_strings(rows)


def _landed(spark, sf):
    path = new_folder(spark, "raw-gkg")
    raw.land_raw(X.gkg(spark, sf), path, F.col("extraction_date"))
    return path


@query(
    "a07_land_raw",
    "select extraction_date as dt, count(*) as rows, sum(NUMARTS)::bigint as articles from gkg group by 1",
    ("gkg",),
)
def _(spark, sf):
    rows = spark.read.parquet(_landed(spark, sf))
    return rows.groupBy("dt").agg(F.count(F.lit(1)).alias("rows"), F.sum("NUMARTS").alias("articles"))


@query(
    "a08_read_raw",
    f"select extraction_date as dt, CAMEOEVENTIDS, THEMES, TONE from gkg where extraction_date = date '{_DAY}'",
    ("gkg",),
)
def _(spark, sf):
    return raw.read_raw(spark, _landed(spark, sf), _DAY).select("dt", "CAMEOEVENTIDS", "THEMES", "TONE")


@query(
    "a09_stamp_lineage",
    "select GlobalEventID, cast(strptime(cast(DATEADDED as varchar), '%Y%m%d') as date) as extraction_date, "
    "cast(strptime(cast(DATEADDED as varchar), '%Y%m%d') as date) as last_modified from geo",
    ("geo",),
)
def _(spark, sf):
    from portrisk.functions.parse import int_date

    return readers.stamp_lineage(X.geo_events(spark, sf).select("GlobalEventID", "DATEADDED"), int_date("DATEADDED")).drop("DATEADDED")


@query(
    "a10_scan_range",
    "select CAMEOEVENTIDS, extraction_date from gkg where extraction_date between date '2024-01-10' and date '2024-01-14'",
    ("gkg",),
)
def _(spark, sf):
    rows = X.gkg(spark, sf).select("CAMEOEVENTIDS", "extraction_date")
    return raw.scan_range(rows, "2024-01-10", "2024-01-14", "extraction_date")


def _table_name(path):
    return "portrisk_" + path.rsplit("-", 1)[1]


@query(
    "a11_create_or_append",
    "select extraction_date, count(*) as rows from gkg group by 1",
    ("gkg",),
)
def _(spark, sf):
    path = new_folder(spark, "table")
    table = _table_name(path)
    rows = X.gkg(spark, sf)
    early = F.col("extraction_date") < F.lit("2024-01-16").cast("date")
    tables.create_or_append(rows.where(early), table, path, "extraction_date")
    tables.create_or_append(rows.where(~early), table, path, "extraction_date")
    return spark.table(table).groupBy("extraction_date").agg(F.count(F.lit(1)).alias("rows"))


@query("a12_create_events_table", _EVENTS_SQL, ("geo",))
def _(spark, sf):
    from portrisk.functions.parse import int_date

    path = new_folder(spark, "events-table")
    table = _table_name(path)
    tables.create_events_table(spark, table, path)
    rows = readers.stamp_lineage(_wide_events(spark, sf), int_date("DATEADDED"))
    tables.create_or_append(rows, table, path, "Day")
    return _event_values(spark.table(table))


@query(
    "a13_backfill_rows",
    "select extraction_date as dt, count(*) as rows from gkg where extraction_date between date '2024-01-05' and date '2024-01-25' group by 1",
    ("gkg",),
)
def _(spark, sf):
    rows, _missing = raw.backfill(spark, _landed(spark, sf), "2024-01-05", "2024-01-25")
    return rows.groupBy("dt").agg(F.count(F.lit(1)).alias("rows"))


@query(
    "a13_backfill_missing_days",
    "select cast(r.d as date) as dt from (select unnest(generate_series(date '2023-12-25', date '2024-02-05', interval 1 day)) as d) r "
    "where cast(r.d as date) not in (select extraction_date from gkg)",
    ("gkg",),
)
def _(spark, sf):
    return raw.backfill(spark, _landed(spark, sf), "2023-12-25", "2024-02-05")[1]


@query(
    "a14_next_date_to_process",
    "select TABLE_NAME, cast(LAST_UPDATE_DATE + interval 1 day as date) as next_date_to_process from control",
    ("control",),
)
def _(spark, sf):
    return control.next_date_to_process(X.control(spark, sf))


@query(
    "a15_advance_control",
    "select TABLE_NAME, case when TABLE_NAME = 'click' then date '2024-02-03' else LAST_UPDATE_DATE end as LAST_UPDATE_DATE, "
    "case when TABLE_NAME = 'click' then timestamp '2024-02-04 06:00:00' else LAST_MODIFIED end as LAST_MODIFIED from control",
    ("control",),
)
def _(spark, sf):
    return control.advance_control(X.control(spark, sf), "click", "2024-02-03", "2024-02-04 06:00:00")


def _versions(rows, column, value):
    """Stored rows until day 20, and a redelivery from day 15 on with a changed value."""
    day = F.col("extraction_date")
    old = rows.where(day <= F.lit("2024-01-20").cast("date"))
    new = rows.where(day >= F.lit("2024-01-15").cast("date")).withColumn(column, value)
    return old, new


def _dated_events(spark, sf):
    from portrisk.functions.parse import int_date

    return readers.stamp_lineage(
        X.geo_events(spark, sf).select("GlobalEventID", "GoldsteinScale", "DATEADDED"), int_date("DATEADDED")
    ).drop("DATEADDED", "last_modified")


_DAY_OF = "cast(strptime(cast(DATEADDED as varchar), '%Y%m%d') as date)"


@query(
    "a16_upsert",
    f"select GlobalEventID, {_DAY_OF} as extraction_date, case when {_DAY_OF} >= date '2024-01-15' "
    "then GoldsteinScale + 1 else GoldsteinScale end as GoldsteinScale from geo",
    ("geo",),
)
def _(spark, sf):
    old, new = _versions(_dated_events(spark, sf), "GoldsteinScale", F.col("GoldsteinScale") + 1)
    return merge.upsert(old, new, ["GlobalEventID"])


@query(
    "a16_upsert_stored",
    f"select GlobalEventID, {_DAY_OF} as extraction_date, case when {_DAY_OF} >= date '2024-01-15' "
    "then GoldsteinScale + 1 else GoldsteinScale end as GoldsteinScale from geo",
    ("geo",),
)
def _(spark, sf):
    old, new = _versions(_dated_events(spark, sf), "GoldsteinScale", F.col("GoldsteinScale") + 1)
    path = new_folder(spark, "bronze-events")
    merge.upsert_into(spark, path, old, ["GlobalEventID"], "extraction_date")
    merge.upsert_into(spark, path, new, ["GlobalEventID"], "extraction_date")
    return spark.read.parquet(path)


_MOVED_DAY = "cast(Day as bigint) + case when GlobalEventID % 10 = 0 then 100 else 0 end"


@query(
    "a16_moved_event",
    f"select GlobalEventID, ({_MOVED_DAY})::int as Day, case when GlobalEventID % 10 < 3 then 'again' else 'first' end as value from geo",
    ("geo",),
)
def _(spark, sf):
    """A third of the events is delivered again, some of them under another day: one row of each stays."""
    first = X.geo_events(spark, sf).select("GlobalEventID", "Day", F.lit("first").alias("value"))
    again = first.where("GlobalEventID % 10 < 3").withColumns({"Day": F.expr(f"cast({_MOVED_DAY} as int)"), "value": F.lit("again")})
    path = new_folder(spark, "moved-events")
    merge.upsert_into(spark, path, first, ["GlobalEventID"], "Day", moving=True)
    for _ in range(2):  # the second delivery changes nothing
        merge.upsert_into(spark, path, again, ["GlobalEventID"], "Day", moving=True)
    return spark.read.parquet(path)


_NEWS_COLUMNS = (*P.NEWS_KEY, "COUNTS", "extraction_date")


@query(
    "a17_upsert_composite",
    # a null in the key never matches: those stored rows stay and the new ones are added
    "with g as (select * replace (nullif(PERSONS, 'nan') as PERSONS) from gkg) "
    "select CAMEOEVENTIDS, PERSONS, case when extraction_date >= date '2024-01-15' then 'new' else 'old' end as COUNTS from g "
    "union all select CAMEOEVENTIDS, PERSONS, 'old' from g where PERSONS is null "
    "and extraction_date between date '2024-01-15' and date '2024-01-20'",
    ("gkg",),
)
def _(spark, sf):
    rows = readers.normalise_null_strings(X.gkg(spark, sf).select(*_NEWS_COLUMNS), ["PERSONS"])
    old, new = _versions(rows.withColumn("COUNTS", F.lit("old")), "COUNTS", F.lit("new"))
    return merge.upsert(old, new, P.NEWS_KEY).select("CAMEOEVENTIDS", "PERSONS", "COUNTS")


@query(
    "a18_insert_only_merge",
    "select CAMEOEVENTIDS, case when extraction_date > date '2024-01-20' then 'new' else 'old' end as COUNTS from gkg",
    ("gkg",),
)
def _(spark, sf):
    rows = X.gkg(spark, sf).select(*_NEWS_COLUMNS)
    old, new = _versions(rows.withColumn("COUNTS", F.lit("old")), "COUNTS", F.lit("new"))
    return merge.insert_only_merge(old, new, P.NEWS_KEY).select("CAMEOEVENTIDS", "COUNTS")


@query(
    "a18_silver_late_news",
    'select d as "Date", loc as "LocationCode", CAMEOEVENTIDS, neg as "ToneNegativeScore", rnk::int as rank from ranked',
    ("ranked",),
)
def _(spark, sf):
    """News that arrive in three deliveries of the same days have the ranks of a single one."""
    from portrisk.plans import daily

    news = X.gkg(spark, sf).withColumn("_part", F.pmod(F.crc32("CAMEOEVENTIDS"), F.lit(3))).drop("extraction_date")
    bronze, silver = (new_folder(spark, layer) for layer in ("late-bronze", "late-silver"))
    for part in range(3):
        news.where(F.col("_part") == part).drop("_part").write.mode("append").partitionBy("DATE").parquet(bronze)
        daily.silver_news(spark, bronze, silver, "2024-01-01", "2024-12-31")
    return spark.read.parquet(silver).select("Date", "LocationCode", "CAMEOEVENTIDS", "ToneNegativeScore", "rank")


@query(
    "a14_control_run",
    "select 'news' as TABLE_NAME, date '2024-01-07' as next_date_to_process, extraction_date as day, count(*) as rows from gkg "
    "where extraction_date between date '2024-01-04' and date '2024-01-06' group by all",
    ("gkg",),
)
def _(spark, sf):
    """Three days run by the stored control table, one of them in a run of its own."""
    from portrisk.plans import daily

    landed = _landed(spark, sf)
    states, bronze = new_folder(spark, "control"), new_folder(spark, "controlled")
    control.store_control(spark, states, "events", "2024-02-01")
    control.store_control(spark, states, "news", "2024-01-03")
    job = lambda day: daily.bronze_news(spark, landed, bronze, day)
    daily.run_day(spark, states, "news", job)
    daily.run_day(spark, states, "news", job, "2024-01-06")
    daily.run_day(spark, states, "news", job, "2024-01-06")  # nothing is left to do
    due = control.next_date_to_process(control.stored_control(spark, states), "news")
    counts = spark.read.parquet(bronze).groupBy(F.col("extraction_date").alias("day")).agg(F.count("*").alias("rows"))
    return counts.join(due)


@query(
    "e1_daily_tables",
    "select d as \"Date\", total as \"Total\", loc as \"LocationCode\", n as \"NumberOfNews\" from weighted",
    ("weighted",),
)
def _(spark, sf):
    """Raw days to bronze, silver and gold tables in two overlapping runs."""
    from portrisk.plans import daily

    bronze, silver, gold = (new_folder(spark, layer) for layer in ("bronze", "silver", "gold"))
    landed = _landed(spark, sf)
    for low, high in (("2024-01-01", "2024-01-20"), ("2024-01-20", "2024-01-31")):
        daily.bronze_news(spark, landed, bronze, low, high)
        daily.silver_news(spark, bronze, silver, low, high)
        daily.gold_report(spark, silver, gold, low, high)
    return spark.read.parquet(gold).select("Date", "Total", "LocationCode", "NumberOfNews")


@query("e1_bronze_events", _EVENTS_SQL, ("geo",))
def _(spark, sf):
    """Landed event days to the bronze table in two overlapping runs."""
    from portrisk.functions.parse import int_date
    from portrisk.plans import daily

    landed, bronze = new_folder(spark, "raw-events"), new_folder(spark, "bronze-events")
    raw.land_raw(_wide_events(spark, sf), landed, int_date("DATEADDED"))
    daily.bronze_events(spark, landed, bronze, "2024-01-01", "2024-01-20")
    daily.bronze_events(spark, landed, bronze, "2024-01-18", "2024-01-31")
    return _event_values(spark.read.parquet(bronze))


@query("e3_daily_predictions")
def _(spark, sf):
    """Train on the stored news, then forecast two consecutive days from them."""
    from portrisk.plans import daily

    bronze, models, gold = (new_folder(spark, n) for n in ("bronze", "models", "predictions"))
    daily.bronze_news(spark, _landed(spark, sf), bronze, "2024-01-01", "2024-01-31")
    daily.train_models(spark, bronze, models, "2024-01-21")
    for today in ("2024-01-29", "2024-01-30"):
        daily.gold_predictions(spark, bronze, models, gold, today)
    return spark.read.parquet(gold)


@query(
    "st01_incremental_ingest",
    f"select GlobalEventID, {_DAY_OF} as extraction_date, case when {_DAY_OF} >= date '2024-01-15' "
    "then GoldsteinScale + 1 else GoldsteinScale end as GoldsteinScale from geo",
    ("geo",),
)
def _(spark, sf):
    old, new = _versions(_dated_events(spark, sf), "GoldsteinScale", F.col("GoldsteinScale") + 1)
    landing, table, progress = (new_folder(spark, n) for n in ("landing", "ingested", "progress"))
    for delivery in (old, new):
        delivery.write.mode("append").parquet(landing)
        incremental_ingest(
            spark, landing, delivery.schema, table, progress, ["GlobalEventID"], "extraction_date"
        )
    return spark.read.parquet(table)


@query(
    "st01_replayed_batch",
    "select GlobalEventID, extraction_date, GoldsteinScale from "
    f"(select GlobalEventID, {_DAY_OF} as extraction_date, GoldsteinScale, unnest(range(case when GlobalEventID % 7 = 0 then 2 else 1 end)) as copy from geo) "
    "where extraction_date <= date '2024-01-20'",
    ("geo",),
)
def _(spark, sf):
    """A batch that holds keys twice, merged, refused as done, and replayed as if its end had been lost."""
    rows, _ = _versions(_dated_events(spark, sf), "GoldsteinScale", F.col("GoldsteinScale"))
    batch = rows.unionByName(rows.where("GlobalEventID % 7 = 0"))
    path, keys, day = new_folder(spark, "replayed"), ["GlobalEventID"], "extraction_date"
    merge.merge_batch(spark, path, batch, keys, day, "feed", 0)
    merge.merge_batch(spark, path, batch, keys, day, "feed", 0)
    merge.note_batch(spark, path, "feed", 1, "started")  # the driver was lost after this
    merge.merge_batch(spark, path, batch, keys, day, "feed", 1)
    return spark.read.parquet(path)
