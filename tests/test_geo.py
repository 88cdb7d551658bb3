"""Coordinates, distances and the grid join against brute force."""

import math
import random

import pytest
from pyspark.sql import functions as F

from portrisk.functions import geo
from portrisk.operators import joins
from tests.conftest import plan_of

# fixed values: published geodesic distances between city pairs, km
PAIRS = [
    ((52.2296756, 21.0122287), (52.406374, 16.9251681), 279.352901604),
    ((41.49008, -71.312796), (41.499498, -81.695391), 866.455),
    ((0.0, 0.0), (0.0, 1.0), 111.319),
    ((0.0, 0.0), (1.0, 0.0), 110.574),
]


@pytest.mark.parametrize("a,b,km", PAIRS)
def test_ellipsoid_distance(spark, a, b, km):
    df = spark.createDataFrame([(*a, *b)], "p double, q double, r double, s double")
    got = geo.with_geodesic_km(df, F.col("p"), F.col("q"), F.col("r"), F.col("s")).first().distance_in_kms
    assert got == pytest.approx(km, rel=1e-5)


def test_equal_points_have_a_distance(spark):
    """The cosine of equal points may round beyond 1; its resolution near 0 is 0.1 m."""
    df = spark.createDataFrame([(49.17, -123.07), (10.0, 20.0), (45.25, -125.5)], "p double, q double")
    for row in geo.with_spherical_km(df, F.col("p"), F.col("q"), F.col("p"), F.col("q")).collect():
        assert 0 <= row.distance_in_kms <= 0.0002
    assert geo.with_geodesic_km(df, F.col("p"), F.col("q"), 49.17, -123.07).first().distance_in_kms == 0


def test_ellipsoid_runs_in_generated_code(spark):
    plan = plan_of(geo.with_geodesic_km(spark.range(1), F.col("id").cast("double"), 2.0, 3.0, 4.0))
    assert "Python" not in plan and "aggregate(" not in plan


def test_filter_on_ellipsoid_distance(spark):
    """The plan stays small, and the grid reaches as far as the ellipsoid at the equator and at 60 degrees."""
    e = spark.createDataFrame([(0, 0.4499, 5.0), (1, 60.2, 10.0), (2, 60.3, 10.0)], "i int, ActionGeo_Lat double, ActionGeo_Long double")
    p = spark.createDataFrame([(0, 0.2244, 5.0), (1, 60.0, 10.1)], "j int, LATITUDE_CORRECTED double, LONGITUDE_CORRECTED double")
    near = joins.ports_within_radius(e, p, measure=geo.with_geodesic_km)
    assert len(plan_of(near)) < 60_000
    assert sorted((r.i, r.j) for r in near.select("i", "j").collect()) == [(0, 0), (1, 1)]


def test_port_coordinates(spark):
    ports = spark.createDataFrame(
        [("A", "north west", "49.25 N", "123.50 W"), ("A", "south east", " 10.5 S", "20.25E"),
         ("A", "wrong axis", "12.5 E", "12.5 N"), ("A", "junk", "x N", "W"), ("A", "none", None, "1 E")],
        "COUNTRY string, PORT string, LATITUDE string, LONGITUDE string",
    )
    got = {r.PORT: (r.LATITUDE_CORRECTED, r.LONGITUDE_CORRECTED) for r in geo.clean_port_coordinates(ports).collect()}
    assert got == {
        "north west": (49.25, -123.5), "south east": (-10.5, 20.25),
        "wrong axis": (999.999, 999.999), "junk": (999.999, 999.999),
    }


def _brute(events, ports, km):
    def distance(a, b):
        p, q = math.radians(a[0]), math.radians(b[0])
        cosine = math.sin(p) * math.sin(q) + math.cos(p) * math.cos(q) * math.cos(math.radians(a[1] - b[1]))
        return round(math.acos(max(-1.0, min(1.0, cosine))) * 6371.0, 4)

    return sorted((i, j) for i, a in enumerate(events) for j, b in enumerate(ports) if distance(a, b) <= km)


@pytest.mark.parametrize("km", [25.0, 300.0, 4000.0])
@pytest.mark.parametrize("shuffled", [False, True])
def test_grid_join_equals_brute_force(spark, km, shuffled):
    """Also at the poles, at the antimeridian and with a third of the events on one spot."""
    rng = random.Random(7)
    ports = [(rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(40)]
    ports += [(89.9, 10.0), (-89.95, -170.0), (0.0, 180.0), (0.0, -180.0), (60.0, 179.95), (10.0, 20.0), (90.0, 0.0)]
    events = [(rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(150)]
    events += [(a + rng.uniform(-0.2, 0.2), b + rng.uniform(-0.2, 0.2)) for a, b in ports if abs(a) < 89]
    events += [(10.0, 20.1)] * 100 + [(89.95, -170.0), (0.0, 179.9), (0.0, -179.9), (60.0, -179.9), (-90.0, 0.0)]
    e = spark.createDataFrame([(i, *p) for i, p in enumerate(events)], "i int, ActionGeo_Lat double, ActionGeo_Long double")
    p = spark.createDataFrame([(j, *p) for j, p in enumerate(ports)], "j int, LATITUDE_CORRECTED double, LONGITUDE_CORRECTED double")
    near = joins.ports_within_radius(e, p, km, broadcast_rows=0 if shuffled else None)
    assert sorted((r.i, r.j) for r in near.select("i", "j").collect()) == _brute(events, ports, km)
    plan = plan_of(near)
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_sentinel_ports_match_nothing(spark):
    e = spark.createDataFrame([(0, 10.0, 20.0)], "i int, ActionGeo_Lat double, ActionGeo_Long double")
    p = spark.createDataFrame([(0, 999.999, 999.999)], "j int, LATITUDE_CORRECTED double, LONGITUDE_CORRECTED double")
    assert joins.ports_within_radius(e, p).count() == 0


def _crowded(spark):
    e = spark.range(400).selectExpr("cast(id as int) as i", "10.0D as ActionGeo_Lat", "20.0D + id % 2 as ActionGeo_Long")
    p = spark.range(30).selectExpr("concat('p', id % 20) as PORT", "10.1D as LATITUDE_CORRECTED", "20.0D as LONGITUDE_CORRECTED")
    return e, p


@pytest.mark.parametrize("rows", [None, 0])
def test_distances_are_measured_once_per_pair_of_positions(spark, rows):
    measured = []

    def measure(df, *args):
        measured.append(df)
        return geo.with_spherical_km(df, *args)

    e, p = _crowded(spark)
    near = joins.ports_within_radius(e, p, measure=measure, broadcast_rows=rows)
    assert near.columns == [*e.columns, *p.columns, "distance_in_kms"]
    assert near.count() == 200 * 30 and near.select("i", "PORT").distinct().count() == 200 * 20
    assert [df.count() for df in measured] == [1]


def test_events_per_port(spark):
    """Equal to counting the pairs, which are not built; ports of one name count together."""
    e, p = _crowded(spark)
    p = p.unionByName(spark.createDataFrame([("p0", 10.0, 21.0), ("far", 50.0, 21.0)], p.schema))
    pairs = joins.ports_within_radius(e, p).groupBy("PORT").agg(F.count("*").alias("events"), F.min("distance_in_kms").alias("nearest_km"))
    got = joins.events_per_port(e, p)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, pairs.collect()))
    assert {r.PORT: r.events for r in got.collect()}["p0"] == 600
