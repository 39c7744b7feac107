"""Rounding, elapsed time and distance expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371.0088
SECONDS_PER_DAY = 86400


def half_even(c: Column, scale: int = 0) -> Column:
    """Round the binary value half to even (1.035 is below the tie and becomes 1.03)."""
    return F.rint(c * 10**scale) / 10**scale


def tenths(c: Column) -> Column:
    """Round a value of 0 to 1000 to one decimal by its exact binary value (6.65 is above the tie, 1.15 below).

    Twenty times the value is compared with the odd number of the tie in two exact parts.
    """
    below = F.floor(c * 10)
    high = F.floor(c * F.lit(float(1 << 30))) / F.lit(float(1 << 30))
    beyond = (high * 20 - (below * 2 + 1)) + (c - high) * 20
    up = (beyond > 0) | ((beyond == 0) & (below % 2 == 1))
    return F.when((c >= 0) & (c <= 1000), (below + up.cast("int")) / F.lit(10.0)).otherwise(half_even(c, 1))


def half_even_long(c: Column) -> Column:
    return F.bround(c, 0).cast("bigint")


def micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def elapsed_seconds(start: Column, end: Column) -> Column:
    """Whole seconds between two instants, never below zero."""
    return F.greatest(F.lit(0), F.floor((micros(end) - micros(start)) / 1_000_000)).cast("bigint")


def elapsed_days(seconds: Column) -> Column:
    return half_even(seconds / SECONDS_PER_DAY, 6)


def great_circle_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    a1, a2 = F.radians(lat1), F.radians(lat2)
    half_lat, half_lon = (a2 - a1) / 2, F.radians(lon2 - lon1) / 2
    h = F.pow(F.sin(half_lat), 2) + F.cos(a1) * F.cos(a2) * F.pow(F.sin(half_lon), 2)
    return 2 * EARTH_RADIUS_KM * F.asin(F.sqrt(F.least(F.lit(1.0), h)))


# The WGS 84 ellipsoid, in kilometres.
AXIS_KM, FLATTENING = 6378.137, 1 / 298.257223563
POLAR_KM = AXIS_KM * (1 - FLATTENING)
GEODESIC_STEPS = 20


def let(body: Callable[[Column], Column], **values: Column) -> Column:
    """body of a struct of values, each of which is worked out once."""
    return F.transform(F.array(F.struct(*[v.alias(k) for k, v in values.items()])), body)[0]


def _on_sphere(s: Column, lam: Column, body: Callable[[Column], Column]) -> Column:
    """Terms of the auxiliary sphere for a difference of longitude, handed to body."""
    across = F.sqrt(F.pow(s["c2"] * F.sin(lam), 2) + F.pow(s["c1"] * s["s2"] - s["s1"] * s["c2"] * F.cos(lam), 2))
    along = s["s1"] * s["s2"] + s["c1"] * s["c2"] * F.cos(lam)

    def with_azimuth(t: Column) -> Column:
        sine = F.when(t["across"] == 0, F.lit(0.0)).otherwise(s["c1"] * s["c2"] * F.sin(lam) / t["across"])
        return let(with_middle, across=t["across"], along=t["along"], angle=F.atan2(t["across"], t["along"]), sine=sine, square=1 - sine * sine)

    def with_middle(t: Column) -> Column:
        middle = F.when(t["square"] < 1e-15, F.lit(0.0)).otherwise(t["along"] - 2 * s["s1"] * s["s2"] / t["square"])
        return let(body, across=t["across"], along=t["along"], angle=t["angle"], sine=t["sine"], square=t["square"], middle=middle)

    return let(with_azimuth, across=across, along=along)


def geodesic_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Length of the geodesic on the ellipsoid by inverse steps (Vincenty 1975), to about a millimetre.

    A step that gives its own value again ends them, since all others would give it too.

    Nearly antipodal points, for which the steps do not settle, have the length on the mean sphere, within 0.6 per cent.
    """
    f, one = F.lit(FLATTENING), F.lit(1.0)

    def step(s: Column) -> Callable[[Column], Column]:
        def next_lambda(t: Column) -> Column:
            c = f / 16 * t["square"] * (4 + f * (4 - 3 * t["square"]))
            turn = t["middle"] + c * t["along"] * (2 * t["middle"] * t["middle"] - 1)
            return s["l"] + (one - c) * f * t["sine"] * (t["angle"] + c * t["across"] * turn)
        return next_lambda

    def length(t: Column) -> Column:
        u = t["square"] * (AXIS_KM**2 - POLAR_KM**2) / POLAR_KM**2
        a = 1 + u / 16384 * (4096 + u * (u * (320 - 175 * u) - 768))
        b = u / 1024 * (256 + u * (u * (74 - 47 * u) - 128))
        m, x = t["middle"], t["across"]
        change = b * x * (m + b / 4 * (t["along"] * (2 * m * m - 1) - b / 6 * m * (4 * x * x - 3) * (4 * m * m - 3)))
        return POLAR_KM * a * (t["angle"] - change)

    def solved(s: Column) -> Column:
        start = F.struct(s["l"].alias("now"), F.lit(None).cast("double").alias("before"))
        found = F.aggregate(F.sequence(F.lit(1), F.lit(GEODESIC_STEPS)), start, lambda acc, _: F.when(
            acc["now"] == acc["before"], acc).otherwise(F.struct(
                _on_sphere(s, acc["now"], step(s)).alias("now"), acc["now"].alias("before"))))
        return let(lambda r: F.when(F.abs(r["x"]["now"] - r["x"]["before"]) < 1e-9, _on_sphere(s, r["x"]["now"], length)), x=found)

    u1, u2 = (F.atan((1 - FLATTENING) * F.tan(F.radians(x))) for x in (lat1, lat2))
    between = F.radians(lon2 - lon1)
    shortest = F.atan2(F.sin(between), F.cos(between))
    exact = let(solved, s1=F.sin(u1), c1=F.cos(u1), s2=F.sin(u2), c2=F.cos(u2), l=shortest)
    return F.coalesce(exact, great_circle_km(lat1, lon1, lat2, lon2))


def straight_line_distance(
    home_lat: Column, home_lon: Column,
    address_lat: Column, address_lon: Column, city_lat: Column, city_lon: Column,
) -> Column:
    """Whole km of the geodesic with method and evidence status; the address is preferred to the city centre."""
    has_address = address_lat.isNotNull() & address_lon.isNotNull()
    has_city = city_lat.isNotNull() & city_lon.isNotNull()
    lat, lon = F.when(has_address, address_lat).otherwise(city_lat), F.when(
        has_address, address_lon).otherwise(city_lon)
    located = has_address | has_city
    return F.struct(
        F.when(located, half_even_long(geodesic_km(home_lat, home_lon, lat, lon)))
        .alias("distance_km"),
        F.when(has_address, F.lit("geodesic_address"))
        .when(has_city, F.lit("geodesic_city_center"))
        .otherwise(F.lit("unavailable")).alias("method"),
        F.when(located, F.lit("straight_line_estimate_from_source_reported_location"))
        .otherwise(F.lit("location_or_geocode_unavailable")).alias("evidence_status"),
    )
