"""Aggregated reports, ranks, growth, sorts and unions."""

from __future__ import annotations

from pyspark.sql import functions as F

from portrisk import fixtures as X
from portrisk import profiles as P
from portrisk.functions.parse import int_date
from portrisk.functions.themes import theme_flags
from portrisk.operators import aggregates, filters, ranking, windows
from portrisk.plans.features import feature_news
from portrisk.plans.report import route_news, scored_news, theme_grid, weighted_report
from portrisk.registry.base import WEIGHT, _COUNT_NAMES, query, risk_total, rounded

_ROUTES = ", ".join(f'"{c}"' for c in P.ROUTE_FLAGS)


def _weighted_sql(third):
    return (
        f'select d as "Date", total as "Total", loc as "LocationCode", {_ROUTES}, n as "NumberOfNews", '
        f"({WEIGHT.format(third=third)})::bigint as \"WeightedCountOfNews\" from weighted"
    )


@query("g01_weighted_report", _weighted_sql("n"), ("weighted",))
def _(spark, sf):
    return weighted_report(route_news(X.gkg(spark, sf)))


@query("g01_weighted_report_fix_total3", _weighted_sql("total"), ("weighted",))
def _(spark, sf):
    return weighted_report(route_news(X.gkg(spark, sf)), fix_total3=True)


@query(
    "g02_theme_growth_base",
    'select d as "Date", total as "Total", loc as "LocationCode", "NewsWithTINFA", "NewsWithME", "NewsWithPS", '
    '"NewsWithMI", themes as "TotalThemesFindings", n as "NumberOfNews" from cells',
    ("cells",),
)
def _(spark, sf):
    return aggregates.theme_growth_base(scored_news(route_news(X.gkg(spark, sf))))


_DAILY_WEIGHT = "select d, loc, sum(w)::bigint as w from grid group by 1, 2"


@query(
    "g03_daily_weight",
    f'select d as "Date", loc as "LocationCode", w as "WeightedCountOfNews" from ({_DAILY_WEIGHT})',
    ("grid",),
)
def _(spark, sf):
    return aggregates.daily_weight(theme_grid(route_news(X.gkg(spark, sf))))


def _pacific(spark, sf):
    return filters.in_locations(feature_news(X.gkg(spark, sf)), "trans_pacific")


_ROUNDED_TONE = (
    '"NegativeNews", round("ToneNegativeScore", 6) as "ToneNegativeScore", round("Polarity", 6) as "Polarity", '
    '"MaxToneNeg", "MinToneNeg"'
)


@query(
    "g04_daily_tone",
    f"select d as \"Date\", {_ROUNDED_TONE} from daily where profile = 'trans_pacific'",
    ("daily",),
)
def _(spark, sf):
    return rounded(aggregates.daily_tone(_pacific(spark, sf)), "ToneNegativeScore", "Polarity")


@query(
    "g05_daily_theme_counts",
    f"select d as \"Date\", {_COUNT_NAMES} from daily where profile = 'trans_pacific'",
    ("daily",),
)
def _(spark, sf):
    return aggregates.daily_theme_counts(_pacific(spark, sf))


@query(
    "g06_daily_goldstein",
    "select cast(strptime(cast(Day as varchar), '%Y%m%d') as date) as \"Date\", "
    "round(avg(greatest(GoldsteinScale, 0)), 6) as \"GoldsteinPositive\", "
    "round(avg(least(GoldsteinScale, 0)), 6) as \"GoldsteinNegative\" from geo "
    "where ActionGeo_CountryCode = 'CH' and Day between 20240105 and 20240125 group by 1 order by 1",
    ("geo",),
)
def _(spark, sf):
    events = filters.event_scope(X.geo_events(spark, sf), ["CH"]).withColumn("Date", int_date("Day"))
    daily = aggregates.daily_goldstein(filters.period(events, "2024-01-05", "2024-01-26"))
    return rounded(daily, "GoldsteinPositive", "GoldsteinNegative")


@query("g07_distinct_dates", 'select distinct d as "Date" from route_news', ("route_news",))
def _(spark, sf):
    return aggregates.distinct_dates(route_news(X.gkg(spark, sf)))


@query(
    "g07_distinct_pairs",
    'select distinct total as "Total", loc as "LocationCode" from scored',
    ("scored",),
)
def _(spark, sf):
    return aggregates.distinct_pairs(scored_news(route_news(X.gkg(spark, sf))))


@query("g08_row_count", "select count(*) as rows from route_news", ("route_news",))
def _(spark, sf):
    return aggregates.row_count(route_news(X.gkg(spark, sf)))


_RANK_SQL = (
    'select d as "Date", loc as "LocationCode", CAMEOEVENTIDS, neg as "ToneNegativeScore", rnk::int as rank from ranked'
)
_RANK_SHOWN = ("Date", "LocationCode", "CAMEOEVENTIDS", "ToneNegativeScore", "rank")


@query("w01_rank_negative", _RANK_SQL, ("ranked",))
def _(spark, sf):
    return ranking.rank_negative(route_news(X.gkg(spark, sf))).select(*_RANK_SHOWN)


@query("w01_rank_negative_ranges", _RANK_SQL, ("ranked",))
def _(spark, sf):
    """The same ranks from many small ranges, which cut most groups."""
    return ranking.rank_negative(route_news(X.gkg(spark, sf)), parts=64).select(*_RANK_SHOWN)


@query("w01_top_negative", f"{_RANK_SQL} where rnk <= 3", ("ranked",))
def _(spark, sf):
    return ranking.top_negative(route_news(X.gkg(spark, sf)), 3).select(*_RANK_SHOWN)


_TOP_SQL = (
    f"select d as \"Date\", CAMEOEVENTIDS, total as \"Total\", rnk as \"Rank\" from (select *, "
    "row_number() over (partition by d order by total desc, CAMEOEVENTIDS, SOURCEURLS)::int as rnk from "
    f"(select *, {risk_total()} as total from route_news where avg_tone < 0))"
)


def _flagged(spark, sf):
    return theme_flags(filters.negative_only(route_news(X.gkg(spark, sf))))


@query("w02_top_themes", f"{_TOP_SQL} where rnk <= 3", ("route_news",))
def _(spark, sf):
    return ranking.top_themes(_flagged(spark, sf)).select("Date", "CAMEOEVENTIDS", "Total", "Rank")


@query("w02_rank_themes", _TOP_SQL, ("route_news",))
def _(spark, sf):
    return ranking.top_themes(_flagged(spark, sf), k=None).select("Date", "CAMEOEVENTIDS", "Total", "Rank")


@query(
    "w03_growth",
    'select d as "Date", total as "Total", loc as "LocationCode", n as "NumberOfNews", coalesce(past, 0) as "NumberOfNewsPastDay", '
    'round(coalesce(g, 0), 6) as "GrowthNumberOfNewsPastDay", '
    'round(coalesce(lag(g) over (partition by total, loc order by d), 0), 6) as "LagGrowthNumberOfNewsPastDay" '
    "from (select *, case when past <> 0 then (n - past) / past end as g from "
    "(select *, lag(n) over (partition by total, loc order by d) as past from grid))",
    ("grid",),
)
def _(spark, sf):
    grown = windows.growth(
        theme_grid(route_news(X.gkg(spark, sf))).select("Date", "Total", "LocationCode", "NumberOfNews")
    )
    return rounded(grown, "GrowthNumberOfNewsPastDay", "LagGrowthNumberOfNewsPastDay")


@query(
    "w03_growth_drill_down",
    "select * from (select d as \"Date\", total as \"Total\", n as \"NumberOfNews\", "
    'coalesce(lag(n) over (partition by total, loc order by d), 0) as "NumberOfNewsPastDay", loc as "LocationCode" from grid) '
    "where \"LocationCode\" = 'CA02'",
    ("grid",),
)
def _(spark, sf):
    grown = windows.growth(theme_grid(route_news(X.gkg(spark, sf))))
    return filters.drill_down(grown, LocationCode="CA02").select(
        "Date", "Total", "NumberOfNews", "NumberOfNewsPastDay", "LocationCode"
    )


@query(
    "w04_lag_weight",
    'select d as "Date", loc as "LocationCode", w as "WeightedCountOfNews", '
    f'coalesce(lag(w, 2) over (partition by loc order by d), 0) as "LagWeightedCountNews" from ({_DAILY_WEIGHT})',
    ("grid",),
)
def _(spark, sf):
    return windows.lag_weight(aggregates.daily_weight(theme_grid(route_news(X.gkg(spark, sf)))))


@query(
    "s01_order_by",
    "select GlobalEventID, DATEADDED from geo order by DATEADDED desc, GlobalEventID",
    ("geo",),
)
def _(spark, sf):
    rows = X.geo_events(spark, sf).select("GlobalEventID", "DATEADDED")
    return rows.orderBy(F.col("DATEADDED").desc(), "GlobalEventID")


@query(
    "s02_preview",
    f"{_weighted_sql('n')} order by d, total desc, loc limit 20",
    ("weighted",),
)
def _(spark, sf):
    report = weighted_report(route_news(X.gkg(spark, sf)))
    return ranking.preview(report, 20, "Date", F.col("Total").desc(), "LocationCode")


@query(
    "s03_combine_routes",
    "select CAMEOEVENTIDS, 'p' as route from route_news where is_ruta_transpacifica = 1 union all "
    "select CAMEOEVENTIDS, 'a' as route from route_news where is_ruta_transatlantica = 1",
    ("route_news",),
)
def _(spark, sf):
    news = route_news(X.gkg(spark, sf))
    on = lambda flag, tag: filters.on_route(news, flag).select(
        "CAMEOEVENTIDS", F.lit(tag).alias("route")
    )
    return aggregates.combine_routes(on("is_ruta_transpacifica", "p"), on("is_ruta_transatlantica", "a"))
