"""Code maps and classifications (FN-12..16, FN-23..25, FN-13).

The tables below are FIXED VALUES that results must agree on; they come from
the public GTFS, GTFS-Realtime and WMO code lists and the model definitions.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values ----------------------------------------------------------
# GTFS route_type code -> mode label; anything else is 'other'.
ROUTE_MODES = [
    ("0", "tram"),
    ("1", "metro"),
    ("2", "rail"),
    ("3", "bus"),
    ("4", "ferry"),
    ("5", "cable_tram"),
    ("6", "aerial_lift"),
    ("7", "funicular"),
]
ROUTE_MODE_OTHER = "other"

# route_id suffix -> service area; anything else is 'other'.
SERVICE_AREAS = [("U", "urban"), ("E", "extra_urban")]

# WMO weather code ranges (inclusive) -> condition; gaps are 'other'.
WEATHER_CONDITIONS = [
    (0, 0, "clear"),
    (1, 3, "cloudy"),
    (45, 48, "fog"),
    (51, 57, "drizzle"),
    (61, 67, "rain"),
    (71, 77, "snow"),
    (80, 82, "rain_showers"),
    (85, 86, "snow_showers"),
    (95, 99, "thunderstorm"),
]

# GTFS-Realtime enum numbers -> names.
ALERT_CAUSES = [
    (1, "UNKNOWN_CAUSE"),
    (2, "OTHER_CAUSE"),
    (3, "TECHNICAL_PROBLEM"),
    (4, "STRIKE"),
    (5, "DEMONSTRATION"),
    (6, "ACCIDENT"),
    (7, "HOLIDAY"),
    (8, "WEATHER"),
    (9, "MAINTENANCE"),
    (10, "CONSTRUCTION"),
    (11, "POLICE_ACTIVITY"),
    (12, "MEDICAL_EMERGENCY"),
]
ALERT_EFFECTS = [
    (1, "NO_SERVICE"),
    (2, "REDUCED_SERVICE"),
    (3, "SIGNIFICANT_DELAYS"),
    (4, "DETOUR"),
    (5, "ADDITIONAL_SERVICE"),
    (6, "MODIFIED_SERVICE"),
    (7, "OTHER_EFFECT"),
    (8, "UNKNOWN_EFFECT"),
    (9, "STOP_MOVED"),
    (10, "NO_EFFECT"),
    (11, "ACCESSIBILITY_ISSUE"),
]
ALERT_SEVERITIES = [
    (1, "UNKNOWN_SEVERITY"),
    (2, "INFO"),
    (3, "WARNING"),
    (4, "SEVERE"),
]
# Values an unset enum field takes (proto2 defaults of the spec).
DEFAULT_CAUSE = 1
DEFAULT_EFFECT = 8
DEFAULT_SEVERITY = 1

# Accessibility codes -> boolean; other codes -> null.
FEED_ACCESSIBILITY = [("2", True), ("3", False)]  # trip-update vehicle
STOP_BOARDING = [("1", True), ("2", False)]  # stops.txt wheelchair_boarding

ENTITY_TYPES = ["route", "stop", "trip", "unknown"]
# ---------------------------------------------------------------------------


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def lookup(col, pairs, default=None) -> Column:
    """Simple ``CASE x WHEN k THEN v ... ELSE default END``; null input -> default."""
    x = _c(col)
    expr = None
    for key, value in pairs:
        expr = (F.when(x == F.lit(key), F.lit(value)) if expr is None
                else expr.when(x == F.lit(key), F.lit(value)))
    return expr.otherwise(F.lit(default)) if default is not None else expr


def route_mode(route_type) -> Column:
    return lookup(route_type, ROUTE_MODES, ROUTE_MODE_OTHER)


def service_area(route_id) -> Column:
    x = _c(route_id)
    expr = None
    for suffix, label in SERVICE_AREAS:
        cond = x.endswith(suffix)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise("other")


def is_night_route(short_name) -> Column:
    """Short name contains 'N'; null stays null (FN-25)."""
    return _c(short_name).contains("N")


def weather_condition(code) -> Column:
    x = _c(code)
    expr = None
    for lo, hi, label in WEATHER_CONDITIONS:
        cond = x.between(lo, hi)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise("other")


def feed_accessibility(code) -> Column:
    return lookup(code, FEED_ACCESSIBILITY)


def stop_boarding(code) -> Column:
    return lookup(code, STOP_BOARDING)


def enum_name(number, pairs, strict: bool = True, what: str = "enum") -> Column:
    """Enum number -> name. Unknown number raises when ``strict`` (as the
    protobuf bindings do), else gives null; null input gives null."""
    x = _c(number)
    expr = lookup(x, pairs)
    if strict:
        expr = expr.when(
            x.isNotNull(),
            F.raise_error(F.concat(F.lit(f"unknown {what} number: "), x.cast("string"))),
        )
    return expr


def cause_name(number, strict: bool = True) -> Column:
    return enum_name(F.coalesce(_c(number), F.lit(DEFAULT_CAUSE)), ALERT_CAUSES, strict, "cause")


def effect_name(number, strict: bool = True) -> Column:
    return enum_name(F.coalesce(_c(number), F.lit(DEFAULT_EFFECT)), ALERT_EFFECTS, strict, "effect")


def severity_name(number, strict: bool = True) -> Column:
    return enum_name(
        F.coalesce(_c(number), F.lit(DEFAULT_SEVERITY)), ALERT_SEVERITIES, strict, "severity"
    )


def entity_type(route_id, stop_id, trip_id) -> Column:
    """Precedence route > stop > trip > unknown (FN-16)."""
    return (
        F.when(_c(route_id).isNotNull(), "route")
        .when(_c(stop_id).isNotNull(), "stop")
        .when(_c(trip_id).isNotNull(), "trip")
        .otherwise("unknown")
    )
