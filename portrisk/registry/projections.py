"""Parsing and scalar operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from portrisk import fixtures as X
from portrisk import profiles as P
from portrisk.functions import geo, parse, themes
from portrisk.functions.text import slice_content
from portrisk.plans.detail import detail_projection
from portrisk.registry.base import (
    FLAGS,
    WEIGHT,
    has,
    query,
    risk_total,
)


@query("b01_with_date", 'select CAMEOEVENTIDS, d as "Date" from news', ("news",))
def _(spark, sf):
    return parse.with_date(X.gkg(spark, sf)).select("CAMEOEVENTIDS", "Date")


@query(
    "b02_dateadded_between",
    "select GlobalEventID, DATEADDED from geo where DATEADDED between 20240105 and 20240120",
    ("geo",),
)
def _(spark, sf):
    rows = X.geo_events(spark, sf).select("GlobalEventID", "DATEADDED")
    return parse.dateadded_between(rows, "2024-01-05", "2024-01-20")


@query(
    "b03_parse_locations",
    "select CAMEOEVENTIDS, country as CountryCode, loc as LocationCode from news",
    ("news",),
)
def _(spark, sf):
    return parse.parse_locations(X.gkg(spark, sf)).select("CAMEOEVENTIDS", "CountryCode", "LocationCode")


@query(
    "b04_parse_tone",
    "select CAMEOEVENTIDS, avg_tone as AverageTone, posi as TonePositiveScore, neg as ToneNegativeScore, "
    "pol as Polarity from news",
    ("news",),
)
def _(spark, sf):
    return parse.parse_tone(X.gkg(spark, sf)).select(
        "CAMEOEVENTIDS", "AverageTone", "TonePositiveScore", "ToneNegativeScore", "Polarity"
    )


@query(
    "b05_route_flags",
    "select CAMEOEVENTIDS, " + FLAGS.replace("(loc in", "coalesce(loc in").replace("))::int", "), false)::int") + " from news",
    ("news",),
)
def _(spark, sf):
    return parse.route_flags(parse.parse_locations(X.gkg(spark, sf))).select("CAMEOEVENTIDS", *P.ROUTE_FLAGS)


_RISK = ", ".join(f"coalesce({has(w)}::int, 0) as {c}" for c, w in P.RISK_THEMES.items())


@query("b06_theme_flags_risk", f'select CAMEOEVENTIDS, {_RISK}, {risk_total()} as "Total" from gkg', ("gkg",))
def _(spark, sf):
    return themes.theme_flags(X.gkg(spark, sf)).select("CAMEOEVENTIDS", *P.RISK_THEMES, "Total")


_TROUBLE = ", ".join(f"coalesce({has(w)}::int, 0) as {c}" for c, w in P.DISRUPTION_THEMES.items())


@query("b07_theme_flags_disruption", f"select CAMEOEVENTIDS, {_TROUBLE} from gkg", ("gkg",))
def _(spark, sf):
    flagged = themes.theme_flags(X.gkg(spark, sf), P.DISRUPTION_THEMES, total=None)
    return flagged.select("CAMEOEVENTIDS", *P.DISRUPTION_THEMES)


@query(
    "b06_theme_flags_token",
    "select CAMEOEVENTIDS, list_contains(string_split(THEMES, ';'), 'TRADE')::int as \"NewsWithTRADE\", "
    "list_contains(string_split(THEMES, ';'), 'PORT')::int as \"Port\" from gkg",
    ("gkg",),
)
def _(spark, sf):
    flagged = themes.theme_flags(X.gkg(spark, sf), {"NewsWithTRADE": "TRADE", "Port": "PORT"}, None, token=True)
    return flagged.select("CAMEOEVENTIDS", "NewsWithTRADE", "Port")


@query(
    "b08_fill_zero",
    "select CAMEOEVENTIDS, loc as \"LocationCode\", coalesce(case when loc is not null then NUMARTS end, 0) as NUMARTS, "
    "coalesce(case when avg_tone < 0 then avg_tone end, 0) as \"AverageTone\" from news",
    ("news",),
)
def _(spark, sf):
    rows = parse.parse_tone(parse.parse_locations(X.gkg(spark, sf))).select(
        "CAMEOEVENTIDS",
        "LocationCode",
        F.when(F.col("LocationCode").isNotNull(), F.col("NUMARTS")).alias("NUMARTS"),
        F.when(F.col("AverageTone") < 0, F.col("AverageTone")).alias("AverageTone"),
    )
    return themes.fill_zero(rows)


def _score_groups(spark, sf):
    scored = themes.theme_flags(parse.parse_news(X.gkg(spark, sf)))
    return scored.groupBy("Date", "Total", "LocationCode").agg(F.count("Total").alias("NumberOfNews"))


def _weights(third):
    return (
        f'select d as "Date", total as "Total", loc as "LocationCode", n as "NumberOfNews", '
        f"({WEIGHT.format(third=third)})::bigint as \"WeightedCountOfNews\" from "
        f"(select d, {risk_total()} as total, loc, count(*) as n from news group by all)"
    )


@query("b09_weight_news", _weights("n"), ("news",))
def _(spark, sf):
    return themes.weight_news(_score_groups(spark, sf))


@query("b09_weight_news_fix_total3", _weights("total"), ("news",))
def _(spark, sf):
    return themes.weight_news(_score_groups(spark, sf), fix_total3=True)


@query(
    "b10_clean_port_coordinates",
    'select COUNTRY, PORT, lat as "LATITUDE_CORRECTED", lon as "LONGITUDE_CORRECTED" from clean_ports',
    ("clean_ports",),
)
def _(spark, sf):
    return geo.clean_port_coordinates(X.ports(spark, sf))


def spherical_sql(lat1, lon1, lat2, lon2):
    return (
        f"round(acos(greatest(-1.0, least(1.0, sin(radians({lat1})) * sin(radians({lat2})) + cos(radians({lat1})) * "
        f"cos(radians({lat2})) * cos(radians({lon1}) - radians({lon2}))))) * 6371.0, 4)"
    )


_LAT, _LON = P.VANCOUVER


@query(
    "b11_spherical_km",
    f"select GlobalEventID, {spherical_sql('ActionGeo_Lat', 'ActionGeo_Long', _LAT, _LON)} as distance_in_kms from geo",
    ("geo",),
)
def _(spark, sf):
    return X.geo_events(spark, sf).select(
        "GlobalEventID",
        geo.spherical_km(F.col("ActionGeo_Lat"), F.col("ActionGeo_Long"), _LAT, _LON).alias("distance_in_kms"),
    )


def ellipsoid_sql(rounds, key="GlobalEventID", source="geo", lat=_LAT, lon=_LON):
    """The inverse solution unrolled, one subquery per step."""
    f, a = geo.WGS84_F, geo.WGS84_A
    b = geo.WGS84_B
    body = (
        f"select id, sin(u1) s1, cos(u1) c1, sin(u2) s2, cos(u2) c2, l, l as lam from (select {key} as id, "
        f"atan({1 - f!r} * tan(radians(ActionGeo_Lat))) as u1, atan({1 - f!r} * tan(radians({lat}))) as u2, "
        f"radians({lon}) - radians(ActionGeo_Long) as l from {source})"
    )
    def angles(inner):
        one = (
            "select *, sqrt(pow(c2 * sin(lam), 2) + pow(c1 * s2 - s1 * c2 * cos(lam), 2)) as ss, "
            f"s1 * s2 + c1 * c2 * cos(lam) as cs from ({inner})"
        )
        two = f"select *, case when ss = 0 then 0 else c1 * c2 * sin(lam) / ss end as sa from ({one})"
        three = f"select *, 1 - sa * sa as ca2 from ({two})"
        return (
            "select *, case when ca2 = 0 then 0 else cs - 2 * s1 * s2 / ca2 end as m, "
            f"{f!r} / 16 * ca2 * (4 + {f!r} * (4 - 3 * ca2)) as c from ({three})"
        )

    for _ in range(rounds):
        body = (
            f"select id, s1, c1, s2, c2, l, l + (1 - c) * {f!r} * sa * (atan2(ss, cs) + c * ss * "
            f"(m + c * cs * (2 * m * m - 1))) as lam from ({angles(body)})"
        )
    usq = f"ca2 * {(a * a - b * b) / (b * b)!r}"
    return (
        f"select id as GlobalEventID, round({b!r} * ba * (atan2(ss, cs) - bb * ss * (m + bb / 4 * (cs * (2 * m * m - 1) "
        f"- bb / 6 * m * (4 * ss * ss - 3) * (4 * m * m - 3)))) / 1000, 6) as distance_in_kms from (select *, "
        f"1 + q / 16384 * (4096 + q * (-768 + q * (320 - 175 * q))) as ba, "
        f"q / 1024 * (256 + q * (-128 + q * (74 - 47 * q))) as bb from (select *, {usq} as q from ({angles(body)})))"
    )


@query("b12_geodesic_km", ellipsoid_sql(6), ("geo",))
def _(spark, sf):
    events = X.geo_events(spark, sf).select("GlobalEventID", "ActionGeo_Lat", "ActionGeo_Long")
    far = geo.with_geodesic_km(events, F.col("ActionGeo_Lat"), F.col("ActionGeo_Long"), _LAT, _LON)
    return far.select("GlobalEventID", F.round("distance_in_kms", 6).alias("distance_in_kms"))


@query(
    "b13_week_keys",
    "select GlobalEventID, d as \"Date\", cast(week(d) as int) as \"YearWeek\", "
    "concat(cast(\"MonthYear\" as varchar), cast(week(d) as varchar)) as \"MonthYearWeek\" from "
    "(select *, cast(strptime(cast(Day as varchar), '%Y%m%d') as date) as d from geo)",
    ("geo",),
)
def _(spark, sf):
    rows = X.geo_events(spark, sf).withColumn("Date", parse.int_date("Day"))
    return parse.week_keys(rows).select("GlobalEventID", "Date", "YearWeek", "MonthYearWeek")


@query(
    "b14_goldstein_split",
    "select GlobalEventID, case when GoldsteinScale > 0 then GoldsteinScale else 0 end as \"GoldsteinPositive\", "
    "case when GoldsteinScale < 0 then GoldsteinScale else 0 end as \"GoldsteinNegative\" from geo",
    ("geo",),
)
def _(spark, sf):
    return parse.goldstein_split(X.geo_events(spark, sf)).select(
        "GlobalEventID", "GoldsteinPositive", "GoldsteinNegative"
    )


@query("b15_slice_content", "select doc_id, substring(text, 201, 3300) as contenturl from documents")
def _(spark, sf):
    rows = X.read(spark, sf, "documents").select("doc_id", F.col("text").alias("contenturl"))
    return slice_content(rows)


@query(
    "b16_detail_projection",
    'select d as "DATE", extraction_date as "EXTRACTION_DATE", country as "COUNTRYCODE", loc as "LOCATIONCODE", '
    'avg_tone as "AVERAGETONE", is_ruta_transpacifica as "IS_RUTA_TRANSPACIFICA", '
    'is_ruta_transatlantica as "IS_RUTA_TRANSATLANTICA", '
    'is_ruta_del_cabo_de_buena_esperanza as "IS_RUTA_DEL_CABO_DE_BUENA_ESPERANZA", SOURCEURLS as "SOURCEURLS", '
    'THEMES as "SUMMARY" from route_news',
    ("route_news",),
)
def _(spark, sf):
    from portrisk.plans.report import route_news

    return detail_projection(route_news(X.gkg(spark, sf)).withColumn("summary", F.col("THEMES")))


@query(
    "b17_tag_prediction_location",
    'select profile, d as "Date", case profile when \'trans_pacific\' then \'transpacific_route\' '
    "when 'trans_atlantic' then 'transatlantic_route' else profile end as \"PredictionLocation\" from daily",
    ("daily",),
)
def _(spark, sf):
    from portrisk.operators.aggregates import daily_features
    from portrisk.operators.joins import route_members
    from portrisk.plans.features import feature_news
    from portrisk.plans.forecast import tag_prediction_location

    daily = daily_features(feature_news(X.gkg(spark, sf)), route_members(spark))
    return tag_prediction_location(daily.select("profile", "Date"))
