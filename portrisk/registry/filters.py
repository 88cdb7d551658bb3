"""Row filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from portrisk import fixtures as X
from portrisk import profiles as P
from portrisk.functions import geo, parse
from portrisk.operators import filters
from portrisk.registry.base import BROAD, CALM, STRICT, query, quoted
from portrisk.registry.projections import ellipsoid_sql, spherical_sql

_ROW = 'select CAMEOEVENTIDS, d as "Date", loc as "LocationCode", avg_tone as "AverageTone" from '
_SHOWN = ("CAMEOEVENTIDS", "Date", "LocationCode", "AverageTone")


def _news(spark, sf):
    return parse.parse_news(X.gkg(spark, sf))


def _register(name, where, apply, source="news"):
    @query(name, f"{_ROW}{source} where {where}", (source,))
    def _(spark, sf):
        return apply(_news(spark, sf)).select(*_SHOWN)


_register(
    "f01_in_locations_profile",
    f"loc in ({quoted(P.TRANS_ATLANTIC)})",
    lambda df: filters.in_locations(df, "trans_atlantic"),
)
_register(
    "f01_in_locations_routes",
    f"loc in ({quoted(P.all_route_locations())})",
    lambda df: filters.in_locations(df, P.all_route_locations()),
)
_register("f02_port_themes_broad", BROAD, filters.port_themes_broad)
_register("f03_port_themes_strict", STRICT, filters.port_themes_strict)
_register("f04_drop_emotional", CALM, filters.drop_emotional)
_register("f05_negative_only", "avg_tone < 0", filters.negative_only)
_register(
    "f06_period",
    "d >= date '2024-01-10' and d < date '2024-01-20'",
    lambda df: filters.period(df, "2024-01-10", "2024-01-20"),
)
_register(
    "f06_since",
    "d >= date '2024-01-30' - 8",
    lambda df: filters.since(df, 8, "2024-01-30"),
)


@query("f06_period_stored", f"{_ROW}news where d >= date '2024-01-10' and d < date '2024-01-20'", ("news",))
def _(spark, sf):
    """The same period cut from raw news by their stored day number, before anything is parsed."""
    raw = filters.period(X.gkg(spark, sf), "2024-01-10", "2024-01-20", "DATE")
    return parse.parse_news(raw).select(*_SHOWN)


_register(
    "f11_drill_down",
    "loc = 'CA02' and d = date '2024-01-23'",
    lambda df: filters.drill_down(
        df.withColumn("Date", F.col("Date").cast("string")), LocationCode="CA02", Date="2024-01-23"
    ).withColumn("Date", F.col("Date").cast("date")),
)


@query(
    "f07_event_scope",
    "select GlobalEventID, EventRootCode, ActionGeo_CountryCode from geo where ActionGeo_CountryCode in ('CA') "
    "and EventRootCode::int in (14, 15, 16, 17, 19, 20, 21, 22)",
    ("geo",),
)
def _(spark, sf):
    scoped = filters.event_scope(X.geo_events(spark, sf), ["CA"], P.DISRUPTIVE_ROOTS)
    return scoped.select("GlobalEventID", "EventRootCode", "ActionGeo_CountryCode")


_CONTENT = (
    "case when event_id % 9 = 0 then null when event_id % 7 = 0 then '404 Client Error: Not Found' "
    "when event_id % 5 = 0 then 'Error 200 OK XID: 33' else props end"
)


@query(
    "f08_drop_scrape_errors",
    f"select event_id, contenturl from (select event_id, {_CONTENT} as contenturl from events) "
    "where contenturl not like '%Client Error%' and contenturl not like '%OK XID%'",
)
def _(spark, sf):
    rows = X.read(spark, sf, "events").selectExpr("event_id", f"{_CONTENT} as contenturl")
    return filters.drop_scrape_errors(rows)


@query(
    "f09_on_route",
    f"{_ROW}route_news where is_ruta_transatlantica = 1",
    ("route_news",),
)
def _(spark, sf):
    from portrisk.plans.report import route_news

    return filters.on_route(route_news(X.gkg(spark, sf)), "is_ruta_transatlantica").select(*_SHOWN)


_AT = (45.0, -125.0)


@query(
    "f10_within_radius",
    f"select GlobalEventID, {spherical_sql('ActionGeo_Lat', 'ActionGeo_Long', *_AT)} as distance_in_kms from geo "
    f"where {spherical_sql('ActionGeo_Lat', 'ActionGeo_Long', *_AT)} <= 250",
    ("geo",),
)
def _(spark, sf):
    distance = geo.spherical_km(F.col("ActionGeo_Lat"), F.col("ActionGeo_Long"), *_AT)
    rows = X.geo_events(spark, sf).select("GlobalEventID", distance.alias("distance_in_kms"))
    return filters.within_radius(rows, F.col("distance_in_kms"), 250)


@query(
    "f10_within_radius_geodesic",
    f"select * from ({ellipsoid_sql(6, lat=_AT[0], lon=_AT[1])}) where distance_in_kms <= 250",
    ("geo",),
)
def _(spark, sf):
    events = X.geo_events(spark, sf).select("GlobalEventID", "ActionGeo_Lat", "ActionGeo_Long")
    far = geo.with_geodesic_km(events, F.col("ActionGeo_Lat"), F.col("ActionGeo_Long"), *_AT)
    near = filters.within_radius(far, F.col("distance_in_kms"), 250)
    return near.select("GlobalEventID", F.round("distance_in_kms", 6).alias("distance_in_kms"))


@query(
    "f12_drop_null_rows",
    f"{_ROW}news where loc is not null and avg_tone is not null",
    ("news",),
)
def _(spark, sf):
    return filters.drop_null_rows(_news(spark, sf), ["LocationCode", "AverageTone"]).select(*_SHOWN)
