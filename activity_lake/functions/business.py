"""Commuting and bonus rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from activity_lake.functions.dates import _named
from activity_lake.sources.tables import write_stage

# Transport modes, the kilometres each allows, contract types
# and the default bonus rate.
PUBLIC_TRANSPORT = "Transports en commun"
MOTOR_VEHICLE = "véhicule thermique/électrique"
ON_FOOT = "Marche/running"
BY_BIKE = "Vélo/Trottinette/Autres"
COMMUTE_LIMIT_KM = {PUBLIC_TRANSPORT: 150, MOTOR_VEHICLE: 250, ON_FOOT: 15, BY_BIKE: 25}
ACTIVE_MODES = [ON_FOOT, BY_BIKE]
CONTRACT_TYPES = ["CDI", "CDD"]
BONUS_RATE = "0.05"

# WGS-84 ellipsoid, kilometres.
_MAJOR = 6378.137
_FLATTENING = 1 / 298.257223563
_MINOR = _MAJOR * (1 - _FLATTENING)
# Vincenty steps; each divides the error by some 300, so that three leave about
# a millimetre on ten thousand kilometres.
GEODESIC_STEPS = 3


def max_distance(mode: Column | str) -> Column:
    """Kilometres a transport mode allows; 0 for an unknown one."""
    limit = F.lit(0)
    for name, km in COMMUTE_LIMIT_KM.items():
        limit = F.when(_named(mode) == name, km).otherwise(limit)
    return limit


def margin_kms(mode: Column | str, distance: Column | str) -> Column:
    return max_distance(mode) - _named(distance)


def is_eligible(mode: Column | str, margin: Column | str, modes: list[str] | None = None) -> Column:
    """Active commuter within the allowed distance; never null."""
    met = _named(mode).isin(modes or ACTIVE_MODES) & (_named(margin) >= 0)
    return F.coalesce(met, F.lit(False))


def bonus_amount(eligible: Column | str, salary: Column | str, rate: str | float = BONUS_RATE) -> Column:
    """Salary times rate, exact in decimal, as a double; 0 when not eligible."""
    amount = _named(salary).cast("decimal(10,2)") * F.lit(str(rate)).cast("decimal(6,4)")
    return F.when(_named(eligible), amount.cast("double")).otherwise(F.lit(0.0))


def with_bonus(df: DataFrame, rate: str | float = BONUS_RATE, modes: list[str] | None = None) -> DataFrame:
    return df.withColumn(
        "is_eligible_bonus", is_eligible("transport_mode", "margin_kms", modes)
    ).withColumn("bonus_amount", bonus_amount("is_eligible_bonus", "salary", rate))


def _arc(n: int) -> list[tuple[str, str]]:
    """Angles of the arc between two reduced points at longitude difference ``_lam``."""
    return [
        (f"_across{n}", f"_c2 * sin(_lam{n})"),
        (f"_along{n}", f"_c1 * _s2 - _s1 * _c2 * cos(_lam{n})"),
        (f"_cos{n}", f"_s1 * _s2 + _c1 * _c2 * cos(_lam{n})"),
        (f"_sin{n}", f"hypot(_across{n}, _along{n})"),
        (f"_sigma{n}", f"atan2(_sin{n}, _cos{n})"),
        (f"_sin_a{n}", f"coalesce(try_divide(_c1 * _across{n}, _sin{n}), 0D)"),
        (f"_cos2_a{n}", f"1 - _sin_a{n} * _sin_a{n}"),
        (f"_mid{n}", f"_cos{n} - coalesce(try_divide(2 * _s1 * _s2, _cos2_a{n}), 0D)"),
    ]


def with_geodesic(
    df: DataFrame, start: tuple[str, str], end: tuple[str, str], name: str
) -> DataFrame:
    """Kilometres along the WGS-84 ellipsoid between two (lat, lon) points, given as SQL.

    Vincenty's inverse formula with a fixed number of steps, as one select
    whose columns build on each other: everything stays in generated code.
    Points near each other's antipodes do not settle and are out of scope.
    """
    f = f"{_FLATTENING!r}D"
    steps = [
        ("_u1", f"atan((1 - {f}) * tan(radians({start[0]})))"),
        ("_u2", f"atan((1 - {f}) * tan(radians({end[0]})))"),
        ("_s1", "sin(_u1)"), ("_c1", "cos(_u1)"), ("_s2", "sin(_u2)"), ("_c2", "cos(_u2)"),
        ("_dlon", f"radians({end[1]} - {start[1]})"), ("_lam0", "_dlon"),
    ]
    for n in range(GEODESIC_STEPS):
        bend = f"(_mid{n} + _k{n} * _cos{n} * (2 * _mid{n} * _mid{n} - 1))"
        steps += [
            *_arc(n),
            (f"_k{n}", f"{f} / 16 * _cos2_a{n} * (4 + {f} * (4 - 3 * _cos2_a{n}))"),
            (f"_lam{n + 1}", f"_dlon + (1 - _k{n}) * {f} * _sin_a{n} * (_sigma{n} + _k{n} * _sin{n} * {bend})"),
        ]
    n = GEODESIC_STEPS
    sine, cosine, mid = f"_sin{n}", f"_cos{n}", f"_mid{n}"
    turn = (f"({cosine} * (2 * {mid} * {mid} - 1)"
            f" - _shift / 6 * {mid} * (4 * {sine} * {sine} - 3) * (4 * {mid} * {mid} - 3))")
    steps += [
        *_arc(n),
        ("_h", f"_cos2_a{n} * {(_MAJOR**2 - _MINOR**2) / _MINOR**2!r}D"),
        ("_scale", "1 + _h / 16384 * (4096 + _h * (-768 + _h * (320 - 175 * _h)))"),
        ("_shift", "_h / 1024 * (256 + _h * (-128 + _h * (74 - 47 * _h)))"),
        (name, f"{_MINOR!r}D * _scale * (_sigma{n} - _shift * {sine} * ({mid} + _shift / 4 * {turn}))"),
    ]
    return df.selectExpr("*", *[f"{sql} as {column}" for column, sql in steps]).select(*df.columns, name)


# Which employees get a measured distance.
POLICIES = {"All": list(COMMUTE_LIMIT_KM), "Relevants": ACTIVE_MODES, "None": []}


def with_distance(
    df: DataFrame, geo: DataFrame, company: tuple[float, float], policy: str = "All"
) -> DataFrame:
    """Kilometres from home to company, two decimals, as ``distance_kms``.

    ``geo`` has ``address, lat, lon``. Employees outside the policy get 0;
    an address without coordinates gives null. One row per address is kept,
    as a written table that is broadcast if it is small; it holds a digest in
    place of the address.
    """
    if not POLICIES[policy]:
        return df.withColumn("distance_kms", F.lit(0.0))
    measured = F.coalesce(F.col("transport_mode").isin(POLICIES[policy]), F.lit(False))
    place = F.sha2("address", 256).alias("_place")
    points = geo.groupBy(place).agg(F.min(F.struct("lat", "lon")).alias("_home"))
    points = write_stage(points, name="points")
    here = (f"{float(company[0])!r}D", f"{float(company[1])!r}D")
    placed = df.withColumn("_place", place).join(points, "_place", "left")
    placed = with_geodesic(placed, here, ("_home.lat", "_home.lon"), "distance_kms")
    kilometres = F.when(measured, F.round("distance_kms", 2)).otherwise(F.lit(0.0))
    return placed.withColumn("distance_kms", kilometres).select(*df.columns, "distance_kms")
