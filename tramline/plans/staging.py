"""Staging models (MOD-1..6): raw landed tables -> typed, cleaned views."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline.functions import codes
from tramline.functions.text import blank_to_null, has_text, text_to_double
from tramline.functions.time import (
    LOCAL_TZ,
    day_name,
    day_of_week,
    epoch_to_utc,
    hour_of,
    interval_between,
    seconds_between,
    to_local,
    within,
)
from tramline.operators.history import HistorySlices
from tramline.operators.joins import join_dimension
from tramline.operators.windows import keep_latest, observation_history

# Keys of the prediction history (G-2: not the service date).
HISTORY_KEYS = ("trip_id", "stop_sequence")


def _utc(df: DataFrame) -> DataFrame:
    """Time helpers treat naive timestamps as UTC: make sure the session does."""
    if df.sparkSession.conf.get("spark.sql.session.timeZone") != "UTC":
        df.sparkSession.conf.set("spark.sql.session.timeZone", "UTC")
    return df


def _local_parts(ts: str, tz: str, prefix: str = "local_", with_name: bool = True) -> list[Column]:
    local = to_local(ts, tz)
    parts = [
        hour_of(local).alias(f"{prefix}hour"),
        day_of_week(local).alias(f"{prefix}day_of_week"),
    ]
    if with_name:
        parts.append(day_name(local).alias(f"{prefix}day_name"))
    return parts


def stg_vehicle_positions(raw: DataFrame, tz: str = LOCAL_TZ) -> DataFrame:
    """Valid-GPS positions with UTC/local time parts (MOD-1, FIL-1, FIL-9).

    ``lat <> 0 AND lon <> 0`` drops a row when either is 0 or null.
    """
    _utc(raw)
    valid = raw.where((F.col("latitude") != 0) & (F.col("longitude") != 0))
    return valid.select(
        "id", "vehicle_id", "vehicle_label", "route_id", "trip_id",
        "trip_start_time", "trip_start_date", "latitude", "longitude", "bearing",
        epoch_to_utc("gps_timestamp").alias("gps_reported_at"),
        "fetched_at",
        to_local("fetched_at", tz).alias("fetched_at_local"),
        *_local_parts("fetched_at", tz),
        has_text("trip_id").alias("has_assigned_trip"),
    )


def stg_weather(raw: DataFrame, tz: str = LOCAL_TZ, method: str = "aggregate") -> DataFrame:
    """Latest fetch per observation time, labelled (MOD-2, WIN-6, FN-15).

    Ties on fetched_at are broken by the row id (G-3).
    """
    _utc(raw)
    latest = keep_latest(
        raw.select("id", "observed_at", "temperature_c", "precipitation_mm",
                   "wind_speed_kmh", "weather_code", "fetched_at"),
        keys=["observed_at"], order=["fetched_at", "id"], method=method,
    )
    return latest.select(
        "observed_at",
        to_local("observed_at", tz).alias("observed_at_local"),
        *_local_parts("observed_at", tz, with_name=False),
        "temperature_c", "precipitation_mm", "wind_speed_kmh", "weather_code",
        codes.weather_condition("weather_code").alias("weather_condition"),
        (F.col("precipitation_mm") > 0).alias("is_precipitating"),
        "fetched_at",
    )


def trip_observations(raw: DataFrame) -> DataFrame:
    """Stop-level observations before their history: rows with a trip and a stop number."""
    _utc(raw)
    extra = ["fetch_date"] if "fetch_date" in raw.columns else []
    return raw.where(F.col("trip_id").isNotNull() & F.col("stop_sequence").isNotNull()).select(
        "id", "trip_id", "trip_start_time", "trip_start_date", "vehicle_id", "vehicle_label",
        "license_plate",
        codes.feed_accessibility("wheelchair_accessible").alias("is_wheelchair_accessible"),
        "stop_sequence", "arrival_delay_seconds", "departure_delay_seconds",
        epoch_to_utc("gps_timestamp").alias("gps_reported_at"),
        "fetched_at", *extra,
    )


def trip_history(spark: SparkSession, path: str, split_keys: bool = False, grain: str = "day") -> HistorySlices:
    """Slices of the prediction history by fetch date, for ``stg_trip_updates_from``."""
    return HistorySlices(spark, path, HISTORY_KEYS, ("fetched_at", "id"), "arrival_delay_seconds", split=split_keys, grain=grain)


def stg_trip_updates_from(history: HistorySlices, trips: DataFrame, tz: str = LOCAL_TZ, dates=None) -> DataFrame:
    """``stg_trip_updates`` from stored slices: only the dates of new raw rows were windowed.

    The trip table is joined to the finished history, so a row per trip is assumed
    (a check of the suite); duplicate trip rows fan out here without counting twice.
    """
    dim = trips.select("trip_id", "route_id", "direction_id", "trip_headsign")
    return _trip_columns(join_dimension(history.read(dates, by=["trip_id"]), dim, on="trip_id", how="left"), tz)


def stg_trip_updates(
    raw: DataFrame,
    trips: DataFrame,
    tz: str = LOCAL_TZ,
    keys=HISTORY_KEYS,
    order=("fetched_at", "id"),
    split_keys: bool = False,
) -> DataFrame:
    """Every stop-level observation with its history metrics (MOD-3).

    route_id comes from the trip table, not the feed (G-8); an unmatched trip
    keeps a null route; duplicate trip rows fan out (JOIN-1). History is per
    (trip_id, stop_sequence) in (fetched_at, id) order (G-2, G-3).
    ``split_keys`` spreads the history of a key of any size over tasks (for feeds whose
    blank trip with unset stops, G-9, holds much of the rows) at the cost of a stored
    copy; the result is the same without.
    """
    dim = trips.select("trip_id", "route_id", "direction_id", "trip_headsign")
    joined = join_dimension(trip_observations(raw).drop("fetch_date"), dim, on="trip_id", how="left")
    hist = observation_history(joined, keys=list(keys), order=list(order),
                               value="arrival_delay_seconds", split=split_keys)
    return _trip_columns(hist, tz)


def _trip_columns(hist: DataFrame, tz: str) -> DataFrame:
    delay = F.col("arrival_delay_seconds")
    return hist.select(
        "trip_id", "route_id", "direction_id", "trip_headsign", "trip_start_time",
        "trip_start_date", "vehicle_id", "vehicle_label", "license_plate",
        "is_wheelchair_accessible", "stop_sequence", "arrival_delay_seconds",
        "departure_delay_seconds",
        F.col("previous_value").alias("previous_delay_seconds"),
        F.col("first_value").alias("first_delay_seconds"),
        (delay - F.col("previous_value")).alias("delay_change_seconds"),
        (delay - F.col("first_value")).alias("delay_drift_seconds"),
        (F.col("stop_sequence") > 1).alias("is_en_route"),
        "observation_number", "total_observations", "recency_rank",
        (F.col("recency_rank") == 1).alias("is_latest_observation"),
        "gps_reported_at", "fetched_at",
        to_local("fetched_at", tz).alias("fetched_at_local"),
        *_local_parts("fetched_at", tz),
    )


def default_as_of() -> Column:
    """Current UTC wall clock (the session time zone is UTC)."""
    return F.current_timestamp().cast("timestamp_ntz")


def stg_alerts(raw: DataFrame, as_of=None, tz: str = LOCAL_TZ, open_end: str = "epoch") -> DataFrame:
    """One row per (alert, route, stop, trip) with its observation window (MOD-4).

    Each content column is the per-group minimum, so a row may mix content
    versions (G-12). Legacy rows without first/last/times fall back to
    fetched_at and a count of 1. ``as_of`` fixes "now" (G-24); an end of 0
    is 1970 unless ``open_end='never'`` (G-10).
    """
    _utc(raw)
    now = default_as_of() if as_of is None else (
        F.lit(as_of).cast("timestamp_ntz") if isinstance(as_of, (str, _dt.datetime)) else as_of
    )
    end = epoch_to_utc("active_period_end")
    if open_end == "never":
        end = F.when(F.col("active_period_end") == 0, F.lit(None).cast("timestamp_ntz")).otherwise(end)
    base = raw.where(F.col("alert_id").isNotNull()).select(
        "alert_id", "cause", "effect", "severity_level", "header_text", "description_text", "url",
        epoch_to_utc("active_period_start").alias("active_from"),
        end.alias("active_until"),
        blank_to_null("informed_route_id").alias("route_id"),
        blank_to_null("informed_stop_id").alias("stop_id"),
        blank_to_null("informed_trip_id").alias("trip_id"),
        F.coalesce("first_seen_at", "fetched_at").alias("first_seen_at"),
        F.coalesce("last_seen_at", "fetched_at").alias("last_seen_at"),
        F.coalesce(F.col("times_seen"), F.lit(1)).alias("times_seen"),
    )
    content = ["cause", "effect", "severity_level", "header_text", "description_text", "url",
               "active_from", "active_until"]
    dedup = base.groupBy("alert_id", "route_id", "stop_id", "trip_id").agg(
        *[F.min(c).alias(c) for c in content],
        F.min("first_seen_at").alias("first_seen_at"),
        F.max("last_seen_at").alias("last_seen_at"),
        F.sum("times_seen").alias("times_observed"),
    )
    if open_end == "never":
        active = (now >= F.col("active_from")) & (
            F.col("active_until").isNull() | (now <= F.col("active_until")))
    else:
        active = within(now, "active_from", "active_until")
    return dedup.select(
        "alert_id", "cause", "effect", "severity_level", "header_text", "description_text", "url",
        "route_id", "stop_id", "trip_id",
        "active_from", "active_until",
        to_local("active_from", tz).alias("active_from_local"),
        to_local("active_until", tz).alias("active_until_local"),
        interval_between("active_until", "active_from").alias("planned_duration"),
        seconds_between("active_until", "active_from").alias("planned_duration_seconds"),
        "first_seen_at", "last_seen_at",
        to_local("first_seen_at", tz).alias("first_seen_at_local"),
        to_local("last_seen_at", tz).alias("last_seen_at_local"),
        interval_between("last_seen_at", "first_seen_at").alias("observed_duration"),
        seconds_between("last_seen_at", "first_seen_at").alias("observed_duration_seconds"),
        "times_observed",
        codes.entity_type("route_id", "stop_id", "trip_id").alias("entity_type"),
        active.alias("is_currently_active"),
    )


def stg_routes(gtfs_routes: DataFrame) -> DataFrame:
    """Routes with mode, service area and night flag (MOD-5)."""
    return gtfs_routes.select(
        "route_id", "agency_id", "route_short_name", "route_long_name", "route_desc",
        "route_type",
        codes.route_mode("route_type").alias("route_mode"),
        "route_url",
        blank_to_null("route_color").alias("route_color_hex"),
        blank_to_null("route_text_color").alias("route_text_color_hex"),
        codes.service_area("route_id").alias("service_area"),
        codes.is_night_route("route_short_name").alias("is_night_route"),
        "loaded_at",
    )


def stg_stops(gtfs_stops: DataFrame) -> DataFrame:
    """Stops with usable coordinates, typed (MOD-6, FIL-3, FN-11)."""
    return gtfs_stops.where(
        blank_to_null("stop_lat").isNotNull() & blank_to_null("stop_lon").isNotNull()
    ).select(
        "stop_id", "stop_code", "stop_name", "stop_desc",
        text_to_double("stop_lat").alias("latitude"),
        text_to_double("stop_lon").alias("longitude"),
        "zone_id", "stop_url",
        blank_to_null("location_type").alias("location_type"),
        blank_to_null("parent_station").alias("parent_station"),
        "stop_timezone", "wheelchair_boarding",
        codes.stop_boarding("wheelchair_boarding").alias("is_wheelchair_accessible"),
        "loaded_at",
    )
