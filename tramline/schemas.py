"""Input and landed-table schemas (see FIXTURES.md)."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)


def _s(*fields) -> StructType:
    return StructType([StructField(n, t, True) for n, t in fields])


S, I, L, D, B, NTZ = StringType(), IntegerType(), LongType(), DoubleType(), BooleanType(), TimestampNTZType()

# --- nested feed snapshots --------------------------------------------------
VEHICLE_DESCRIPTOR = _s(("id", S), ("label", S), ("license_plate", S), ("wheelchair_accessible", I))
TRIP_DESCRIPTOR = _s(("trip_id", S), ("route_id", S), ("start_time", S), ("start_date", S))
POSITION = _s(("latitude", D), ("longitude", D), ("bearing", D))

VEHICLE_FEED = _s(
    ("fetched_at", NTZ),
    ("entity", ArrayType(_s(
        ("id", S),
        ("vehicle", _s(
            ("vehicle", VEHICLE_DESCRIPTOR),
            ("trip", TRIP_DESCRIPTOR),
            ("position", POSITION),
            ("timestamp", L),
        )),
    ))),
)

STOP_TIME_EVENT = _s(("delay", I))
STOP_TIME_UPDATE = _s(("stop_sequence", I), ("arrival", STOP_TIME_EVENT), ("departure", STOP_TIME_EVENT))
TRIP_FEED = _s(
    ("fetched_at", NTZ),
    ("entity", ArrayType(_s(
        ("id", S),
        ("trip_update", _s(
            ("trip", TRIP_DESCRIPTOR),
            ("vehicle", VEHICLE_DESCRIPTOR),
            ("timestamp", L),
            ("stop_time_update", ArrayType(STOP_TIME_UPDATE)),
        )),
    ))),
)

TRANSLATED = _s(("translation", ArrayType(_s(("text", S), ("language", S)))))
ALERT_FEED = _s(
    ("fetched_at", NTZ),
    ("entity", ArrayType(_s(
        ("id", S),
        ("alert", _s(
            ("cause", I),
            ("effect", I),
            ("severity_level", I),
            ("header_text", TRANSLATED),
            ("description_text", TRANSLATED),
            ("url", TRANSLATED),
            ("active_period", ArrayType(_s(("start", L), ("end", L)))),
            ("informed_entity", ArrayType(_s(
                ("route_id", S), ("stop_id", S), ("trip", _s(("trip_id", S))),
            ))),
        )),
    ))),
)

WEATHER_FEED = _s(
    ("fetched_at", NTZ),
    ("current", _s(
        ("time", S),
        ("temperature_2m", D),
        ("precipitation", D),
        ("wind_speed_10m", D),
        ("weather_code", I),
    )),
)

# --- landed tables ------------------------------------------------------------
RAW_VEHICLE_POSITIONS = _s(
    ("id", L), ("vehicle_id", S), ("vehicle_label", S), ("route_id", S), ("trip_id", S),
    ("trip_start_time", S), ("trip_start_date", S), ("latitude", D), ("longitude", D),
    ("bearing", D), ("gps_timestamp", L), ("fetched_at", NTZ),
)
RAW_TRIP_UPDATES = _s(
    ("id", L), ("trip_id", S), ("route_id", S), ("trip_start_time", S), ("trip_start_date", S),
    ("vehicle_id", S), ("vehicle_label", S), ("license_plate", S), ("wheelchair_accessible", S),
    ("stop_sequence", I), ("arrival_delay_seconds", I), ("departure_delay_seconds", I),
    ("gps_timestamp", L), ("fetched_at", NTZ),
)
RAW_ALERTS = _s(
    ("id", L), ("alert_id", S), ("content_hash", S), ("cause", S), ("effect", S),
    ("severity_level", S), ("header_text", S), ("description_text", S), ("url", S),
    ("active_period_start", L), ("active_period_end", L), ("informed_route_id", S),
    ("informed_stop_id", S), ("informed_trip_id", S), ("first_seen_at", NTZ),
    ("last_seen_at", NTZ), ("times_seen", I), ("fetched_at", NTZ),
)
RAW_WEATHER = _s(
    ("id", L), ("observed_at", NTZ), ("temperature_c", D), ("precipitation_mm", D),
    ("wind_speed_kmh", D), ("weather_code", I), ("fetched_at", NTZ),
)

# Columns the alert fold keys on (G-17: null entity parts compare as '').
ALERT_KEY = ["alert_id", "content_hash", "informed_route_id", "informed_stop_id", "informed_trip_id"]
# Fields of the content fingerprint, in hash order (G-16).
ALERT_CONTENT = [
    "cause", "effect", "severity_level", "header_text", "description_text", "url",
    "active_period_start", "active_period_end",
]
