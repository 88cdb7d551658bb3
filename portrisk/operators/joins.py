"""Joins: dictionaries, grids of dates, profiles, pages, ports in range."""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from portrisk import profiles as P
from portrisk.functions.geo import with_spherical_km
from portrisk.functions.parse import first_url, root_code
from portrisk.functions.themes import fill_zero
from portrisk.operators.filters import within_radius
from portrisk.session import broadcast_if_small, freeze

KM_PER_DEGREE = math.pi * P.EARTH_RADIUS_KM / 180


def label_cameo(events: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Add the description of the root code; events without one are dropped."""
    named = dictionary.where(F.col("DESCRIPTION").isNotNull()).select(
        root_code(F.col("`CAMEO CODE`")).alias("_code"), "DESCRIPTION"
    )
    code = root_code("EventRootCode")
    return events.join(broadcast_if_small(named), code == F.col("_code")).drop("_code")


def date_spine(
    dates: DataFrame, groups: DataFrame, calendar: bool = False
) -> DataFrame:
    """Every group on every date: each group unfolds the date range by itself.

    ``dates`` holds the Date values that occur; reduce a large table to its dates
    beforehand, it is read twice. With ``calendar`` the days between the first
    and the last are all kept, otherwise only those that occur.
    """
    span = dates.agg(F.struct(F.min("Date").alias("low"), F.max("Date").alias("high"))).scalar()
    days = F.sequence(span["low"], span["high"])
    grid = groups.distinct().withColumn("Date", F.explode(days))
    if calendar:
        return grid
    return grid.join(dates.select("Date").distinct(), "Date", "left_semi")


def densify(spine: DataFrame, facts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Facts on a complete grid, zero where nothing happened."""
    added = [c for c in facts.columns if c not in keys]
    return fill_zero(spine.join(facts, list(keys), "left"), added)


def route_members(
    spark: SparkSession, members: Mapping[str, Sequence[str]] = P.PROFILES
) -> DataFrame:
    """(profile, LocationCode) pairs of the configuration: a few dozen rows."""
    pairs = [(name, code) for name, codes in members.items() for code in codes]
    return spark.createDataFrame(pairs, "profile string, LocationCode string")


def explode_profiles(df: DataFrame, members: DataFrame) -> DataFrame:
    """One copy of a row per profile its location belongs to.

    Fan-out is bounded by the number of profiles per location. Aggregate by
    location first where possible, so few rows are copied.
    """
    return df.join(broadcast_if_small(members), "LocationCode")


def attach_summary(news: DataFrame, summaries: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All news, with the summary of those that have one."""
    return news.join(summaries.drop("contenturl"), list(keys), "left")


def attach_pages(news: DataFrame, pages: DataFrame, text: Callable[[str], Column]) -> DataFrame:
    """Add the text of the page a news row points to (null if it is not stored).

    The stored pages are the large side: they are first reduced to the addresses
    in demand, and only those are parsed. Of several pages under one address the
    greatest text counts, so a news row stays one row.
    """
    keyed = news.withColumn("_url", first_url())
    wanted = keyed.select(F.col("_url").alias("url")).where(F.col("url").isNotNull()).distinct()
    contents = pages.join(wanted, "url", "left_semi").select(
        F.col("url").alias("_url"), text("html").alias("contenturl")
    ).groupBy("_url").agg(F.max("contenturl").alias("contenturl"))
    return keyed.join(contents, "_url", "left").drop("_url")


def _cells(km: float) -> tuple[int, float]:
    """Cells per circle and their width in degrees; a cell is at least ``km`` high."""
    count = max(1, math.floor(360 / (km / KM_PER_DEGREE)))
    return count, 360 / count


def _salted_join(left: DataFrame, right: DataFrame, on: Column, salt: int, broadcast_rows: int | None) -> DataFrame:
    """Inner join with a broadcast right side; a long one is copied per salt and meets the left rows of that ``_salt``."""
    small = broadcast_if_small(right, *([broadcast_rows] if broadcast_rows is not None else []))
    if small is not right:
        return left.join(small, on)
    copies = right.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(salt - 1))))
    return left.join(copies, on & (F.col("_salt") == F.col("_copy"))).drop("_copy")


def ports_near_places(
    places: DataFrame,
    ports: DataFrame,
    km: float = P.PORT_RADIUS_KM,
    measure: Callable[..., DataFrame] = with_spherical_km,
    salt: int = 16,
    broadcast_rows: int | None = None,
) -> DataFrame:
    """Places and the port positions within ``km`` of them, by an equi-join on grid cells.

    ``places`` has one row per position (ActionGeo_Lat, ActionGeo_Long). Each position
    of a port, taken once, is listed in every cell its circle can touch: one row of cells up
    and down, and as many left and right as the circle spans at that latitude,
    around the antimeridian if need be. A place lies in one cell, so a pair is
    found once; the distance then decides. Should the list be too long to
    broadcast, both sides shuffle on cell and salt, so a crowded cell is spread
    over ``salt`` tasks.
    """
    around, width = _cells(km)
    # a little wider than the circle: a degree on the ellipsoid has up to 0.6 % fewer km than on the sphere
    reach = km / KM_PER_DEGREE * 1.007 + 1e-6
    lat, lon = F.col("LATITUDE_CORRECTED"), F.col("LONGITUDE_CORRECTED")
    edge = F.least(F.abs(lat) + reach, F.lit(90.0))
    # half-width in longitude of a circle of angular radius r at latitude p: asin(sin r / cos p)
    sine = F.sin(F.radians(F.lit(reach))) / F.cos(F.radians(lat))
    span = F.when(edge >= 89.999, F.lit(180.0)).otherwise(
        F.degrees(F.asin(F.least(sine, F.lit(1.0)))) + 1e-6
    )
    rows = F.sequence(
        F.floor((lat - reach) / width).cast("int"), F.floor((lat + reach) / width).cast("int")
    )
    first_col = F.floor((lon - span) / width).cast("int")
    last_col = F.least(F.floor((lon + span) / width).cast("int"), first_col + around - 1)
    cols = F.transform(F.sequence(first_col, last_col), lambda c: F.pmod(c, F.lit(around)))
    listed = (
        ports.where(lat.between(-90, 90) & lon.between(-180, 180))
        .select("LATITUDE_CORRECTED", "LONGITUDE_CORRECTED")
        .distinct()
        .withColumn("_prow", F.explode(rows))
        .withColumn("_pcol", F.explode(F.array_distinct(cols)))
    )
    placed = places.withColumns(
        {
            "_row": F.floor(F.col("ActionGeo_Lat") / width).cast("int"),
            "_col": F.pmod(
                F.floor(F.col("ActionGeo_Long") / width).cast("int"), F.lit(around)
            ),
            "_salt": F.pmod(F.xxhash64("ActionGeo_Lat", "ActionGeo_Long"), F.lit(salt)).cast("int"),
        }
    )
    same_cell = (F.col("_row") == F.col("_prow")) & (F.col("_col") == F.col("_pcol"))
    paired = _salted_join(placed, listed, same_cell, salt, broadcast_rows)
    paired = paired.drop("_row", "_col", "_prow", "_pcol", "_salt")
    near = measure(paired, F.col("ActionGeo_Lat"), F.col("ActionGeo_Long"), lat, lon)
    return within_radius(near, F.col("distance_in_kms"), km)


_EVENT_PLACE, _PORT_PLACE = ("ActionGeo_Lat", "ActionGeo_Long"), ("LATITUDE_CORRECTED", "LONGITUDE_CORRECTED")


def _same_place(columns: Sequence[str], others: Sequence[str]) -> Column:
    return (F.col(columns[0]) == F.col(others[0])) & (F.col(columns[1]) == F.col(others[1]))


def ports_within_radius(
    events: DataFrame,
    ports: DataFrame,
    km: float = P.PORT_RADIUS_KM,
    measure: Callable[..., DataFrame] = with_spherical_km,
    salt: int = 16,
    broadcast_rows: int | None = None,
) -> DataFrame:
    """Events and the ports within ``km`` of them.

    Events and ports share positions, so distances are measured once per pair of positions and
    stored; events and ports are then joined to their positions. What is left to do per pair is to
    write it. A list that is too long to broadcast is joined by position and salt, so
    the events of a crowded place are spread over ``salt`` tasks.
    """
    places = events.select(*_EVENT_PLACE).distinct()
    near = freeze(ports_near_places(places, ports, km, measure, salt, broadcast_rows)).select(
        *[F.col(c).alias(f"_{c}") for c in (*_EVENT_PLACE, *_PORT_PLACE)], F.col("distance_in_kms").alias("_km")
    )
    # by position in the table, not by content: copies of one event must spread too
    spread = F.pmod(F.monotonically_increasing_id(), F.lit(salt)).cast("int")
    at_place, at_port = ([f"_{c}" for c in place] for place in (_EVENT_PLACE, _PORT_PLACE))
    found = _salted_join(
        events.withColumn("_salt", spread), near, _same_place(_EVENT_PLACE, at_place), salt, broadcast_rows
    )
    paired = _salted_join(found, ports, _same_place(at_port, _PORT_PLACE), salt, broadcast_rows)
    return paired.withColumn("distance_in_kms", F.col("_km")).drop(*at_place, *at_port, "_km", "_salt")


def events_per_port(
    events: DataFrame,
    ports: DataFrame,
    km: float = P.PORT_RADIUS_KM,
    measure: Callable[..., DataFrame] = with_spherical_km,
    salt: int = 16,
    broadcast_rows: int | None = None,
) -> DataFrame:
    """Number of events within ``km`` of each port that has any (by name), and the nearest's distance.

    Events are counted by position before they meet the ports, and summed by position of the port
    before its ports are looked up, so no pair of an event and a port is ever built.
    """
    counted = events.groupBy(*_EVENT_PLACE).agg(F.count(F.lit(1)).alias("_n"))
    near = ports_near_places(counted, ports, km, measure, salt, broadcast_rows)
    at_place = near.groupBy(*_PORT_PLACE).agg(F.sum("_n").alias("_n"), F.min("distance_in_kms").alias("_km"))
    return ports.join(at_place, list(_PORT_PLACE)).groupBy("PORT").agg(
        F.sum("_n").alias("events"), F.min("_km").alias("nearest_km")
    )
