"""Coordinates and distances, all as native expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from portrisk import profiles as P

# fixed values: WGS-84 ellipsoid
WGS84_A = 6378137.0
WGS84_F = 1 / 298.257223563
WGS84_B = WGS84_A * (1 - WGS84_F)


def _c(value) -> Column:
    return value if isinstance(value, Column) else F.lit(float(value))


def _signed(text: Column, positive: str, negative: str) -> Column:
    """'49.25N' -> 49.25; a letter of the other axis, or junk, -> the sentinel."""
    letter = F.upper(F.right(text, F.lit(1)))
    value = F.substring(text, F.lit(1), F.length(text) - 1).try_cast("double")
    signed = F.when(letter == positive, value).when(letter == negative, -value)
    return F.coalesce(signed, F.lit(P.BAD_COORDINATE))


def clean_port_coordinates(ports: DataFrame) -> DataFrame:
    """Ports with signed decimal coordinates; ports without coordinates are dropped."""
    squeeze = lambda c: F.replace(F.col(c), F.lit(" "), F.lit(""))
    return ports.where(F.col("LATITUDE").isNotNull() & F.col("LONGITUDE").isNotNull()).select(
        "COUNTRY",
        "PORT",
        _signed(squeeze("LATITUDE"), "N", "S").alias("LATITUDE_CORRECTED"),
        _signed(squeeze("LONGITUDE"), "E", "W").alias("LONGITUDE_CORRECTED"),
    )


def spherical_km(lat1, lon1, lat2, lon2) -> Column:
    """Great-circle distance by the law of cosines, rounded to 4 digits.

    Rounding can push the cosine just beyond 1 for equal points, hence the clamp.
    """
    p1, p2 = F.radians(_c(lat1)), F.radians(_c(lat2))
    dl = F.radians(_c(lon1)) - F.radians(_c(lon2))
    cosine = F.sin(p1) * F.sin(p2) + F.cos(p1) * F.cos(p2) * F.cos(dl)
    clamped = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), cosine))
    return F.round(F.acos(clamped) * P.EARTH_RADIUS_KM, 4)


def with_spherical_km(df: DataFrame, lat1, lon1, lat2, lon2, name: str = "distance_in_kms") -> DataFrame:
    return df.withColumn(name, spherical_km(lat1, lon1, lat2, lon2))


# Terms of one step of the ellipsoid solution; each may use the ones before it.
_ANGLES = (
    "c2 * sin(lam) as x",
    "cos(lam) as cl",
    "c1 * s2 - s1 * c2 * cl as y",
    "s1 * s2 + c1 * c2 * cl as cs",
    "sqrt(x * x + y * y) as ss",
    "case when ss = 0 then 0D else c1 * x / ss end as sa",
    "1 - sa * sa as ca2",
    "atan2(ss, cs) as sigma",
    "case when ca2 = 0 then 0D else cs - 2 * s1 * s2 / ca2 end as m",
)


def with_geodesic_km(
    df: DataFrame, lat1, lon1, lat2, lon2, name: str = "distance_in_kms", rounds: int = 6
) -> DataFrame:
    """Add the distance on the WGS-84 ellipsoid (Vincenty's inverse solution).

    Each round is one projection in which later columns use earlier ones, so the
    iteration on the auxiliary longitude runs in generated code. A round shrinks
    the error by the flattening (about 1/298): six leave less than a millimetre,
    except between nearly antipodal points, where the method does not settle.
    A filter on the distance would be pushed down the chain and copy its terms at
    every step; the list of one distance that is unfolded at the end stops it there.
    The columns of ``df`` travel in one struct, out of the way of the short names.
    At least one coordinate must be a column of ``df``: Catalyst expands a chain
    of constants before it folds them.
    """
    f, b = f"{WGS84_F!r}D", f"{WGS84_B!r}D"
    kept = F.struct(*[F.col(f"`{column}`") for column in df.columns]).alias("row")
    reduced = lambda lat: F.atan((1 - WGS84_F) * F.tan(F.radians(_c(lat))))
    longitude = F.radians(_c(lon2)) - F.radians(_c(lon1))
    fixed = ("row", "l", "s1", "c1", "s2", "c2")
    out = df.select(
        kept, reduced(lat1).alias("u1"), reduced(lat2).alias("u2"), longitude.alias("l")
    ).selectExpr(
        "row", "l", "sin(u1) as s1", "cos(u1) as c1", "sin(u2) as s2", "cos(u2) as c2", "l as lam"
    )
    for _ in range(rounds):
        out = out.selectExpr(
            *fixed,
            "lam",
            *_ANGLES,
            f"{f} / 16 * ca2 * (4 + {f} * (4 - 3 * ca2)) as k",
            f"l + (1 - k) * {f} * sa * (sigma + k * ss * (m + k * cs * (2 * m * m - 1))) as next",
        ).selectExpr(*fixed, "next as lam")
    return out.selectExpr(
        "row",
        "s1", "c1", "s2", "c2", "lam",
        *_ANGLES,
        f"ca2 * {(WGS84_A**2 - WGS84_B**2) / WGS84_B**2!r}D as q",
        "1 + q / 16384 * (4096 + q * (-768 + q * (320 - 175 * q))) as big_a",
        "q / 1024 * (256 + q * (-128 + q * (74 - 47 * q))) as big_b",
        "cs * (2 * m * m - 1) - big_b / 6 * m * (4 * ss * ss - 3) * (4 * m * m - 3) as part",
        f"{b} * big_a * (sigma - big_b * ss * (m + big_b / 4 * part)) / 1000 as km",
    ).select("row.*", F.explode(F.array("km")).alias(name))
