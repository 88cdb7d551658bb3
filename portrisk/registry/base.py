"""Registration of queries and the shared parts of their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from portrisk import fixtures as X
from portrisk import profiles as P

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# the test series spans 30 days, so training ends within it
SPLIT = "2024-01-21"
SCALED = tuple(P.FEATURES)


def query(name: str, sql: str | None = None, needs: tuple[str, ...] = ()):
    """Register a query, and its SQL on top of the named common table expressions."""
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = with_parts(sql, needs)
        return fn

    return add


def quoted(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    """Doubles to six digits, where the engines may differ in the last bit."""
    return df.withColumns({c: F.round(c, 6) for c in columns})


def _columns(parts) -> str:
    return ", ".join(parts)


_LOC = "nullif(split_part(LOCATIONS, '#', {0}), '')"
_TONE = "try_cast(nullif(split_part(TONE, ',', {0}), '') as double)"


def has(word: str) -> str:
    return f"contains(THEMES, '{word}')"


def risk_total() -> str:
    return " + ".join(f"coalesce({has(w)}::int, 0)" for w in P.RISK_THEMES.values())


BROAD = (
    "(" + " or ".join(has(w) for w in ("PORT", "TRANSPORT", "SHIPPING", "MARITIME", "TRADE_PORT",
                                        "NAVAL_PORT", "LOGISTICS_PORT")) + f") and not {has('AIRPORT')}"
)
STRICT = f"{has('PORT')} and {has('TRANSPORT')} and not {has('AIRPORT')}"
CALM = "(case when avg_tone >= -0.5 and avg_tone <= 0.5 and pol >= 9 then 1 else 0 end) = 0"
FLAGS = ", ".join(
    f"(loc in ({quoted(codes)}))::int as {flag}" if codes else f"0 as {flag}"
    for flag, codes in P.ROUTE_FLAGS.items()
)
WEIGHT = (
    "case when total = 5 then n * 500 when total = 4 then n * 250 "
    "when {third} = 3 then n * 100 when total = 2 then n * 5 else 0 end"
)

_MEMBERS = ", ".join(f"('{p}', '{c}')" for p, codes in P.PROFILES.items() for c in codes)
_PAGE_TEXT = r"""regexp_replace(regexp_replace(regexp_replace(regexp_replace(html,
  '(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>', '', 'g'),
  '(?i)<p(?:\s[^>]*)?>', chr(1), 'g'),
  '(?i)</(?:p|div|article|section|main|body|html|td|li|footer|nav)\s*>', chr(2), 'g'),
  '(?s)<[^>]*>', '', 'g')"""
_DECODED = (
    "replace(replace(replace(replace(replace(replace(replace(replace(replace(t,"
    " '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&apos;', ''''), '&#39;', ''''),"
    " '&nbsp;', ' '), '&copy;', '©'), '&middot;', '·'), '&amp;', '&')"
)
_COUNTS = ", ".join(
    f"count(*) filter (where {has(P.DISRUPTION_THEMES[flag])}) as {name}"
    for flag, name in P.DISRUPTION_COUNTS.items()
)
_COUNT_NAMES = ", ".join(P.DISRUPTION_COUNTS.values())
_CAMEO = ", ".join(
    f"('{code}', {'null' if text is None else repr(text)})" for code, text in X.cameo_rows()
)

# name -> (needed parts, SQL)
PARTS: dict[str, tuple[tuple[str, ...], str]] = {
    "gkg": ((), f"select event_id, {_columns(X.gkg_columns(X.DUCK))} from events"),
    "linked": (
        (),
        f"select event_id, {_columns(X.gkg_columns(X.DUCK, 'url'))} from events join pages "
        "on event_id % (select count(*) from pages) = page_id",
    ),
    "geo": ((), f"select {_columns(X.geo_event_columns(X.DUCK))} from events"),
    "ports": (
        (),
        f"select {_columns(X.port_columns(X.DUCK))} from supplier join nation on s_nationkey = n_nationkey",
    ),
    "cameo": ((), f"select * from (values {_CAMEO}) as t(code, description)"),
    "members": ((), f"select * from (values {_MEMBERS}) as t(profile, loc)"),
    "control": (
        (),
        "select event_type as TABLE_NAME, cast(max(ts) as date) as LAST_UPDATE_DATE, "
        "cast(cast(max(ts) as date) as timestamp) as LAST_MODIFIED from events group by 1",
    ),
    "clean_ports": (
        ("ports",),
        "select COUNTRY, PORT, case right(la, 1) when 'N' then try_cast(left(la, -1) as double) "
        "when 'S' then -try_cast(left(la, -1) as double) else 999.999 end as lat, "
        "case right(lo, 1) when 'E' then try_cast(left(lo, -1) as double) "
        "when 'W' then -try_cast(left(lo, -1) as double) else 999.999 end as lon from "
        "(select COUNTRY, PORT, replace(LATITUDE, ' ', '') as la, replace(LONGITUDE, ' ', '') as lo "
        "from ports where LATITUDE is not null and LONGITUDE is not null)",
    ),
    "route_news": (
        ("news",),
        f"select *, {FLAGS} from news where loc in ({quoted(P.all_route_locations())}) and {BROAD}",
    ),
    "ranked": (
        ("route_news",),
        "select *, row_number() over (partition by d, loc order by neg desc nulls last, "
        "CAMEOEVENTIDS, SOURCEURLS) as rnk from route_news",
    ),
    "scored": (
        ("route_news",),
        f"select *, {risk_total()} as total from route_news where {STRICT} and {CALM} and avg_tone < 0",
    ),
    "weighted": (
        ("scored",),
        "select d, total, loc, " + ", ".join(P.ROUTE_FLAGS) + ", count(*) as n from scored group by all",
    ),
    "cells": (
        ("scored",),
        "select d, total, loc, "
        + ", ".join(
            f"sum({has(w)}::int)::bigint as {c}" for c, w in P.RISK_THEMES.items() if c != "NewsWithTRADE"
        )
        + ", sum(total)::bigint as themes, count(*) as n from scored group by all",
    ),
    "grid": (
        ("cells", "route_news"),
        f"select s.d, p.total, p.loc, coalesce(c.n, 0) as n, coalesce(c.themes, 0) as themes, "
        + ", ".join(f"coalesce(c.{c}, 0) as {c}" for c in P.RISK_THEMES if c != "NewsWithTRADE")
        + f", coalesce({WEIGHT.format(third='c.n').replace('total =', 'c.total =').replace(' n *', ' c.n *')}, 0)::bigint as w "
        "from (select distinct d from route_news) s cross join (select distinct total, loc from cells) p "
        "left join cells c on c.d = s.d and c.total = p.total and c.loc = p.loc",
    ),
    "feature_news": (
        ("news",),
        f"select * from news where {BROAD} and {CALM} and avg_tone < 0",
    ),
    "daily": (
        ("feature_news", "members"),
        "select profile, d, count(*) as NegativeNews, coalesce(avg(neg), 0) as ToneNegativeScore, "
        "coalesce(avg(pol), 0) as Polarity, coalesce(max(neg), 0) as MaxToneNeg, "
        f"coalesce(min(neg), 0) as MinToneNeg, {_COUNTS} from feature_news join members using (loc) group by all",
    ),
    "changed": (
        ("daily",),
        "select * from (select *, cast(NegativeNews - lag(NegativeNews) over (partition by profile order by d) "
        "as double) as raw_diff from daily) where raw_diff is not null",
    ),
    "frame": (
        ("changed",),
        "select c.* exclude (raw_diff), greatest(q.lo, least(q.hi, c.raw_diff)) as Diff, "
        f"case when d < date '{SPLIT}' then 'train' else 'test' end as split from changed c join "
        "(select profile, quantile_cont(raw_diff, 0.02) as lo, quantile_cont(raw_diff, 0.99) as hi "
        "from changed group by 1) q using (profile)",
    ),
    "limits": (
        ("frame",),
        "select profile, "
        + ", ".join(
            f"min({c})::double as {c}_min, case when max({c}) = min({c}) then 1.0 else (max({c}) - min({c}))::double end as {c}_range"
            for c in SCALED
        )
        + " from frame where split = 'train' group by 1",
    ),
    "scaled": (
        ("frame", "limits"),
        "select f.profile, f.d, f.split, "
        + ", ".join(f"(f.{c} - l.{c}_min) / l.{c}_range as {c}" for c in SCALED)
        + " from frame f join limits l using (profile)",
    ),
    "naive": (
        ("frame",),
        "select * from (select *, lag(Diff, 7) over (partition by profile, split order by d) as prediction "
        "from frame) where prediction is not null",
    ),
    "page_text": (
        (),
        "select page_id, url, "
        f"{_DECODED} as content from (select page_id, url, array_to_string(list_transform("
        f"string_split(m, chr(1))[2:], lambda p: split_part(p, chr(2), 1)), ' ') as t from "
        f"(select page_id, url, {_PAGE_TEXT} as m from pages))",
    ),
}


def parsed(source: str) -> str:
    """The parsed form of a news part: d, country, loc and the four tone numbers."""
    return (
        f"select *, cast(strptime(cast(DATE as varchar), '%Y%m%d') as date) as d, "
        f"{_LOC.format(3)} as country, {_LOC.format(4)} as loc, {_TONE.format(1)} as avg_tone, "
        f"{_TONE.format(2)} as posi, {_TONE.format(3)} as neg, {_TONE.format(4)} as pol from {source}"
    )


PARTS["news"] = (("gkg",), parsed("gkg"))
PARTS["window_rows"] = (
    ("scaled",),
    "select s.profile, s.split, s.d, s.\"Diff\" as target, (w.i - s.i + 7) as step, "
    "w.* exclude (profile, split, d, i) from "
    "(select *, row_number() over (partition by profile, split order by d) as i from scaled) s join "
    "(select *, row_number() over (partition by profile, split order by d) as i from scaled) w "
    "on w.profile = s.profile and w.split = s.split and w.i between s.i - 7 and s.i - 1 where s.i > 7",
)
PARTS["linked_news"] = (("linked",), parsed("linked"))
PARTS["linked_silver"] = (
    ("linked_news", "page_text"),
    "select r.*, case when rnk <= 3 then p.content end as contenturl from (select *, "
    "row_number() over (partition by d, loc order by neg desc nulls last, CAMEOEVENTIDS, SOURCEURLS) as rnk "
    f"from (select *, {FLAGS} from linked_news where loc in ({quoted(P.all_route_locations())}) and {BROAD})) r "
    "left join page_text p on p.url = split_part(r.SOURCEURLS, '<UDIV>', 1)",
)


def with_parts(sql: str, needs: tuple[str, ...]) -> str:
    order: list[str] = []

    def visit(name: str) -> None:
        for needed in PARTS[name][0]:
            visit(needed)
        if name not in order:
            order.append(name)

    for name in needs:
        visit(name)
    if not order:
        return sql
    head = ",\n".join(f"{name} as ({PARTS[name][1]})" for name in order)
    return f"with {head},\n{sql[5:]}" if sql.startswith("with ") else f"with {head}\n{sql}"
