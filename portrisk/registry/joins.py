"""Joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from portrisk import fixtures as X
from portrisk import profiles as P
from portrisk.functions import geo
from portrisk.functions.parse import parse_locations
from portrisk.functions.themes import theme_flags
from portrisk.operators import aggregates, filters, joins, ranking
from portrisk.plans.features import feature_news
from portrisk.plans.report import build_silver, route_news, scored_news, theme_grid
from portrisk.registry.base import _COUNT_NAMES, query, quoted, risk_total, rounded
from portrisk.registry.projections import ellipsoid_sql, spherical_sql
from portrisk.session import freeze


@query(
    "j01_label_cameo",
    "select g.GlobalEventID, g.EventRootCode, c.description as DESCRIPTION from geo g join cameo c "
    f"on g.EventRootCode = c.code where c.description is not null and g.ActionGeo_CountryCode in ({quoted(P.PACIFIC_COUNTRIES)})",
    ("geo", "cameo"),
)
def _(spark, sf):
    events = filters.event_scope(X.geo_events(spark, sf), P.PACIFIC_COUNTRIES)
    labelled = joins.label_cameo(events, X.cameo(spark))
    return labelled.select("GlobalEventID", "EventRootCode", "DESCRIPTION")


_PAIRS = "(select distinct total, loc from scored)"


@query(
    "j02_date_spine",
    f'select s.d as "Date", p.total as "Total", p.loc as "LocationCode" from (select distinct d from route_news) s cross join {_PAIRS} p',
    ("route_news", "scored"),
)
def _(spark, sf):
    news = route_news(X.gkg(spark, sf))
    dates = freeze(aggregates.distinct_dates(news))
    pairs = aggregates.distinct_pairs(scored_news(news))
    return joins.date_spine(dates, pairs).select("Date", "Total", "LocationCode")


@query(
    "j02_date_spine_calendar",
    'select cast(s.x as date) as "Date", p.profile from (select unnest(generate_series(min(d), max(d), interval 1 day)) as x from daily) s '
    "cross join (select distinct profile from daily) p",
    ("daily",),
)
def _(spark, sf):
    daily = freeze(aggregates.daily_features(feature_news(X.gkg(spark, sf)), joins.route_members(spark)))
    return joins.date_spine(daily, daily.select("profile"), calendar=True).select("Date", "profile")


@query(
    "j03_densify",
    'select d as "Date", total as "Total", loc as "LocationCode", "NewsWithTINFA", "NewsWithME", "NewsWithPS", "NewsWithMI", '
    'themes as "TotalThemesFindings", n as "NumberOfNews", w as "WeightedCountOfNews" from grid',
    ("grid",),
)
def _(spark, sf):
    return theme_grid(route_news(X.gkg(spark, sf)))


_FEATURES_ROUNDED = (
    '"NegativeNews", round("ToneNegativeScore", 6) as "ToneNegativeScore", round("Polarity", 6) as "Polarity", '
    f'"MaxToneNeg", "MinToneNeg", {_COUNT_NAMES}'
)


@query("j04_daily_features", f'select profile, d as "Date", {_FEATURES_ROUNDED} from daily', ("daily",))
def _(spark, sf):
    daily = aggregates.daily_features(feature_news(X.gkg(spark, sf)), joins.route_members(spark))
    return rounded(daily, "ToneNegativeScore", "Polarity")


@query(
    "j05_attach_summary",
    "select n.d as \"Date\", n.rnk as \"Rank\", n.CAMEOEVENTIDS, case when n.rnk <= 3 then n.THEMES end as summary from "
    f"(select *, row_number() over (partition by d order by {risk_total()} desc, CAMEOEVENTIDS, SOURCEURLS)::int as rnk "
    "from route_news where is_ruta_transpacifica = 1 and avg_tone < 0) n",
    ("route_news",),
)
def _(spark, sf):
    news = filters.on_route(filters.negative_only(route_news(X.gkg(spark, sf))), "is_ruta_transpacifica")
    ranked = ranking.top_themes(theme_flags(news), k=None)
    best = ranked.where(F.col("Rank") <= 3)
    summaries = best.select("Date", "Rank", "is_ruta_transpacifica", F.col("THEMES").alias("summary"))
    attached = joins.attach_summary(ranked, summaries, ["Date", "Rank", "is_ruta_transpacifica"])
    return attached.select("Date", "Rank", "CAMEOEVENTIDS", "summary")


@query(
    "j06_attach_pages",
    "select CAMEOEVENTIDS, rnk::int as rank, contenturl from linked_silver",
    ("linked_silver",),
)
def _(spark, sf):
    silver = build_silver(X.linked_gkg(spark, sf), X.spread(spark, sf, "pages"))
    return silver.select("CAMEOEVENTIDS", "rank", "contenturl")


_NEAR = spherical_sql("g.ActionGeo_Lat", "g.ActionGeo_Long", "p.lat", "p.lon")


@query(
    "j07_ports_within_radius",
    f"select g.GlobalEventID, p.PORT, {_NEAR} as distance_in_kms from geo g, clean_ports p "
    f"where p.lat between -90 and 90 and p.lon between -180 and 180 and {_NEAR} <= 25",
    ("geo", "clean_ports"),
)
def _(spark, sf):
    ports = geo.clean_port_coordinates(X.ports(spark, sf))
    near = joins.ports_within_radius(X.geo_events(spark, sf), ports)
    return near.select("GlobalEventID", "PORT", "distance_in_kms")


@query(
    "j07_ports_within_radius_shuffled",
    f"select g.GlobalEventID, p.PORT, {_NEAR} as distance_in_kms from geo g, clean_ports p "
    f"where p.lat between -90 and 90 and p.lon between -180 and 180 and {_NEAR} <= 25",
    ("geo", "clean_ports"),
)
def _(spark, sf):
    """The same pairs by the salted shuffle that serves long port lists."""
    ports = geo.clean_port_coordinates(X.ports(spark, sf))
    near = joins.ports_within_radius(X.geo_events(spark, sf), ports, broadcast_rows=0)
    return near.select("GlobalEventID", "PORT", "distance_in_kms")


_PAIR = "{'event': GlobalEventID, 'port': PORT}"
_NEARBY = "geo, clean_ports where lat between -90 and 90 and lon between -180 and 180"


@query(
    "j07_ports_within_radius_geodesic",
    "select GlobalEventID.event as GlobalEventID, GlobalEventID.port as PORT, distance_in_kms from "
    f"({ellipsoid_sql(6, _PAIR, _NEARBY, 'lat', 'lon')}) where distance_in_kms <= 25",
    ("geo", "clean_ports"),
)
def _(spark, sf):
    ports = geo.clean_port_coordinates(X.ports(spark, sf))
    near = joins.ports_within_radius(X.geo_events(spark, sf), ports, measure=geo.with_geodesic_km)
    return near.select("GlobalEventID", "PORT", F.round("distance_in_kms", 6).alias("distance_in_kms"))


@query(
    "j07_events_per_port",
    f"select p.PORT, count(*) as events, round(min({_NEAR}), 3) as nearest_km from geo g, clean_ports p "
    f"where p.lat between -90 and 90 and p.lon between -180 and 180 and {_NEAR} <= 25 group by 1",
    ("geo", "clean_ports"),
)
def _(spark, sf):
    ports = geo.clean_port_coordinates(X.ports(spark, sf))
    counts = joins.events_per_port(X.geo_events(spark, sf), ports)
    return counts.withColumn("nearest_km", F.round("nearest_km", 3))


@query(
    "j08_unmatched_rows",
    "select CAMEOEVENTIDS, PERSONS from gkg where PERSONS = 'nan' or extraction_date > date '2024-01-20'",
    ("gkg",),
)
def _(spark, sf):
    """News of the second delivery that the first does not hold (null keys never match)."""
    from portrisk.sources.merge import unmatched
    from portrisk.sources.readers import normalise_null_strings

    rows = normalise_null_strings(X.gkg(spark, sf), ["PERSONS"])
    first = rows.where(F.col("extraction_date") <= F.lit("2024-01-20").cast("date"))
    new = unmatched(rows, first, P.NEWS_KEY, null_safe=False)
    return new.select("CAMEOEVENTIDS", F.coalesce("PERSONS", F.lit("nan")).alias("PERSONS"))


@query(
    "j09_explode_profiles",
    "select CAMEOEVENTIDS, loc as \"LocationCode\", profile from news join members using (loc)",
    ("news", "members"),
)
def _(spark, sf):
    news = parse_locations(X.gkg(spark, sf)).select("CAMEOEVENTIDS", "LocationCode")
    return joins.explode_profiles(news, joins.route_members(spark)).select("CAMEOEVENTIDS", "LocationCode", "profile")
