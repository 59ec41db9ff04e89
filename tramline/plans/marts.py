"""Marts (MOD-7..9): route punctuality, hourly service with weather, alert impact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.functions.numeric import pct, round_half_away, round_half_even, round_numeric
from tramline.functions.time import day_name, day_of_week, hour_bucket, hour_of, is_weekend, seconds_between
from tramline.operators.joins import join_dimension

# Punctuality band (seconds) and the sparse-hour threshold (position reports).
ON_TIME_SECONDS = 60
SPARSE_HOUR_REPORTS = 1500


def punctual_observations(stg_trip_updates: DataFrame) -> DataFrame:
    """Latest, en-route, non-zero predictions (FIL-4).

    The filter sits above the history window: the latest rank is computed on
    all rows first, so a zero last prediction drops its key (G-1).
    """
    return stg_trip_updates.where(
        F.col("is_en_route")
        & F.col("is_latest_observation")
        & (F.col("arrival_delay_seconds") != 0)
    )


def _delay_profile(obs: DataFrame, by: str, approx: bool = False) -> DataFrame:
    """Delay statistics per group in two aggregations that both combine map-side.

    Every observation counts twice: once under its delay and once under its trip. The
    first aggregation reduces these to one row per (group, delay) and (group, trip), so
    the percentiles run over value counts in one buffer per group, and distinct trips
    are a count of rows. Neither a group nor a trip is ever held in one task.
    ``approx=True`` takes sketches of the delays and trips instead.
    """
    d, n = F.col("d"), F.col("n")
    delay = F.col("arrival_delay_seconds")
    long = obs.select(
        by, F.coalesce(F.col("is_wheelchair_accessible"), F.lit(False)).cast("long").alias("access"), "fetched_at_local",
        F.explode(F.array(F.struct(delay.alias("d"), F.lit(None).cast("string").alias("trip")),
                          F.struct(F.lit(None).cast("int").alias("d"), F.col("trip_id").alias("trip")))).alias("x"))
    counted = long.groupBy(by, F.col("x.d").alias("d"), F.col("x.trip").alias("trip")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("access").alias("access"),
        F.min("fetched_at_local").alias("first"), F.max("fetched_at_local").alias("last"))

    def total(cond):
        return F.sum(F.when(cond, n).otherwise(0))

    def weighted(x):
        return F.coalesce(F.sum((x * n).cast("decimal(38,0)")), F.lit(0))

    rows = total(d.isNotNull())
    s1, s2 = weighted(d.cast("decimal(18,0)")), weighted(d.cast("decimal(18,0)") * d)
    spread = (s2.cast("double") * rows - s1.cast("double") * s1.cast("double")) / (rows * (rows - 1))
    if approx:
        quantiles = F.percentile_approx(F.when(d.isNotNull(), d.cast("double")), [0.5, 0.9], 10000)
        trips = F.approx_count_distinct("trip")
    else:
        quantiles = F.percentile(d, [0.5, 0.9], n)
        trips = F.count("trip")
    return counted.groupBy(by).agg(
        rows.alias("observations"), trips.alias("trips_observed"),
        round_half_away((s1 / rows).cast("double")).alias("avg_delay_seconds"), quantiles.alias("quantiles"),
        round_half_away(F.when(rows > 1, F.sqrt(F.greatest(spread, F.lit(0.0))))).alias("stddev_delay_seconds"),
        F.min("d").alias("max_early_seconds"), F.max("d").alias("max_late_seconds"),
        pct(total(d > ON_TIME_SECONDS), rows).alias("pct_late"),
        pct(total(d < -ON_TIME_SECONDS), rows).alias("pct_early"),
        pct(total(F.abs(d) <= ON_TIME_SECONDS), rows).alias("pct_on_time"),
        pct(F.sum(F.when(d.isNotNull(), F.col("access")).otherwise(0)), rows).alias("pct_wheelchair_accessible"),
        F.min("first").alias("first_observed_at"), F.max("last").alias("last_observed_at"),
    ).withColumns({"median_delay_seconds": round_half_even(F.get("quantiles", 0)),
                   "p90_delay_seconds": round_half_even(F.get("quantiles", 1))})


ROUTE_LABELS = ("route_short_name", "route_long_name", "route_mode", "service_area", "is_night_route")


def fct_route_performance(
    stg_trip_updates: DataFrame,
    stg_routes: DataFrame,
    approx: bool = False,
) -> DataFrame:
    """One row per route: counts, mean/median/p90/stddev, extremes, shares (MOD-7).

    Observations are reduced to a row per route before they meet the route's labels.
    ``approx=True`` swaps the exact percentiles and distinct count for their
    sketch versions (bounded memory per group, results no longer exact).
    """
    profile = _delay_profile(punctual_observations(stg_trip_updates), "route_id", approx)
    return join_dimension(profile, stg_routes.select("route_id", *ROUTE_LABELS), on="route_id").select(
        "route_id", *ROUTE_LABELS, "observations", "trips_observed", "avg_delay_seconds", "median_delay_seconds",
        "p90_delay_seconds", "stddev_delay_seconds", "max_early_seconds", "max_late_seconds", "pct_late", "pct_early",
        "pct_on_time", "pct_wheelchair_accessible", "first_observed_at", "last_observed_at")


def hourly_fleet(stg_vehicle_positions: DataFrame) -> DataFrame:
    """Fleet size per local hour bucket (first part of MOD-8).

    Positions are first reduced to one row per (hour, vehicle, route) with
    the report count and whether any report had a trip (a plain hash
    aggregation, combined map-side); the three distinct counts then expand
    that much smaller set instead of every position report.
    """
    per_vehicle = stg_vehicle_positions.groupBy(
        hour_bucket("fetched_at_local").alias("hour_bucket"), "vehicle_id", "route_id"
    ).agg(
        F.count(F.lit(1)).alias("reports"),
        F.bool_or("has_assigned_trip").alias("on_trip"),
    )
    return per_vehicle.groupBy("hour_bucket").agg(
        F.count_distinct("vehicle_id").alias("active_vehicles"),
        F.count_distinct("route_id").alias("active_routes"),
        F.sum("reports").alias("position_reports"),
        F.count_distinct(F.when(F.col("on_trip"), F.col("vehicle_id"))).alias(
            "vehicles_on_a_trip"),
    )


def hourly_delays(stg_trip_updates: DataFrame, approx: bool = False) -> DataFrame:
    """Punctuality per local hour bucket (second half of MOD-8)."""
    obs = punctual_observations(stg_trip_updates).withColumn("hour_bucket", hour_bucket("fetched_at_local"))
    return _delay_profile(obs, "hour_bucket", approx).select(
        "hour_bucket", F.col("observations").alias("delay_observations"), "trips_observed", "avg_delay_seconds",
        "median_delay_seconds", "pct_late")


def hourly_weather(stg_weather: DataFrame) -> DataFrame:
    """Weather per local hour bucket (third part of MOD-8); the dominant
    condition is the most frequent one, ties to the smallest (AGG-12)."""
    return stg_weather.groupBy(hour_bucket("observed_at_local").alias("hour_bucket")).agg(
        round_numeric(F.avg("temperature_c"), 1).alias("avg_temperature_c"),
        round_numeric(F.sum("precipitation_mm"), 1).alias("total_precipitation_mm"),
        round_numeric(F.avg("wind_speed_kmh"), 1).alias("avg_wind_speed_kmh"),
        F.bool_or("is_precipitating").alias("had_precipitation"),
        F.mode("weather_condition", deterministic=True).alias("dominant_condition"),
    )


def fct_hourly_service(
    stg_vehicle_positions: DataFrame,
    stg_trip_updates: DataFrame,
    stg_weather: DataFrame,
    sparse_threshold: int = SPARSE_HOUR_REPORTS,
    approx: bool = False,
) -> DataFrame:
    """One row per local hour with fleet, delay and weather (MOD-8).

    The three halves are aggregated separately (each pre-aggregates map-side)
    and left-joined from the fleet side, so hours without positions vanish
    (G-22). The outputs are one row per hour: small, so AQE broadcasts them.
    ``approx`` takes sketches for the delays' median and distinct trips.
    """
    fleet = hourly_fleet(stg_vehicle_positions)
    delays = hourly_delays(stg_trip_updates, approx)
    weather = hourly_weather(stg_weather)
    hb = F.col("hour_bucket")
    return (
        fleet.join(delays, "hour_bucket", "left")
        .join(weather, "hour_bucket", "left")
        .select(
            "hour_bucket",
            hour_of(hb).alias("local_hour"),
            day_name(hb).alias("local_day_name"),
            day_of_week(hb).alias("local_day_of_week"),
            is_weekend(hb).alias("is_weekend"),
            "active_vehicles", "active_routes", "vehicles_on_a_trip", "position_reports",
            "delay_observations", "trips_observed", "avg_delay_seconds", "median_delay_seconds",
            "pct_late",
            "avg_temperature_c", "total_precipitation_mm", "avg_wind_speed_kmh",
            "had_precipitation", "dominant_condition",
            (F.col("position_reports") < sparse_threshold).alias("is_sparse_hour"),
        )
        .orderBy("hour_bucket")
    )


def fct_alert_impact(stg_alerts: DataFrame, stg_routes: DataFrame) -> DataFrame:
    """Route-level alerts with route labels and stops affected (MOD-9).

    Stops are counted per alert, shared by all its routes (G-21): distinct (alert, stop) pairs
    first, then a count per alert, both reduced before they are dealt, and a left join that
    gives alerts without a named stop a zero (JOIN-4). An alert with much of the rows
    is spread by adaptive skew splitting. Alerts on unknown routes drop (inner
    join, G-27); ``planned_duration`` here is on local clocks (G-20).
    """
    stops = stg_alerts.where(F.col("stop_id").isNotNull()).select("alert_id", "stop_id").distinct()
    counts = stops.groupBy(F.col("alert_id").alias("_alert")).agg(F.count(F.lit(1)).alias("_stops"))
    routed = stg_alerts.where(F.col("route_id").isNotNull())
    on_routes = (routed.join(counts, routed["alert_id"] == counts["_alert"], "left")
                 .withColumn("stops_affected", F.coalesce("_stops", F.lit(0).cast("long"))))
    labels = stg_routes.select("route_id", *ROUTE_LABELS[:-1])
    return join_dimension(on_routes, labels, on="route_id").select(
        "route_id", *ROUTE_LABELS[:-1], "alert_id", "effect", "cause", "severity_level", "header_text", "stops_affected",
        "active_from_local", "active_until_local",
        (F.col("active_until_local") - F.col("active_from_local")).alias("planned_duration"),
        seconds_between("active_until_local", "active_from_local").alias("planned_duration_seconds"),
        "is_currently_active", "first_seen_at_local", "last_seen_at_local", "times_observed",
    )


def unmatched_route_alerts(stg_alerts: DataFrame, stg_routes: DataFrame) -> DataFrame:
    """Route-level alerts whose route is not in the timetable: the rows the
    impact mart drops (G-27), reported instead of silently lost."""
    return (stg_alerts.where(F.col("route_id").isNotNull()).select("route_id", "alert_id")
            .join(stg_routes.select("route_id"), "route_id", "left_anti"))
