"""Ad-hoc reports (MOD-10, AGG-16, DQ-6)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.functions.numeric import pct, round_half_away
from tramline.functions.time import hour_bucket


def fleet_curve(stg_vehicle_positions: DataFrame) -> DataFrame:
    """Distinct active vehicles per UTC hour."""
    return (
        stg_vehicle_positions.groupBy(hour_bucket("fetched_at").alias("hour_utc"))
        .agg(F.count_distinct("vehicle_id").alias("active_vehicles"))
        .orderBy("hour_utc")
    )


def effect_share(stg_alerts: DataFrame, only_active: bool = True) -> DataFrame:
    """Distinct alerts per effect and their share of all distinct alerts (AGG-16).

    The total is a scalar subquery (one-row aggregate), so no join is needed.
    An alert with several effects counts once under each.
    """
    alerts = stg_alerts.where(F.col("is_currently_active")) if only_active else stg_alerts
    # One rollup gives the per-effect counts and the grand total; the total is
    # read back by a scalar subquery over the same aggregate, whose exchange
    # Spark reuses instead of recomputing the alert roll-up.
    counts = alerts.select("alert_id", "effect").rollup("effect").agg(
        F.count_distinct("alert_id").alias("alerts"), F.grouping("effect").alias("_total"))
    total = counts.where(F.col("_total") == 1).select("alerts").scalar()
    return counts.where(F.col("_total") == 0).select(
        "effect", "alerts", pct(F.col("alerts"), total).alias("pct_of_alerts"))


def gps_dropout(raw_positions: DataFrame) -> DataFrame:
    """Share of position reports without a usable fix (DQ-6).

    A report is invalid when latitude or longitude is 0 or null, i.e. exactly
    the rows the staging filter drops.
    """
    valid = F.coalesce((F.col("latitude") != 0) & (F.col("longitude") != 0), F.lit(False))
    n = F.count(F.lit(1))
    return raw_positions.agg(
        n.alias("position_reports"),
        F.count_if(~valid).alias("invalid_reports"),
        pct(F.count_if(~valid), n).alias("dropout_pct"),
    )


def mean_delay(raw_trip_updates: DataFrame) -> DataFrame:
    """Mean arrival delay over all predictions, whole seconds half away from zero."""
    d = F.col("arrival_delay_seconds")
    return raw_trip_updates.agg(
        F.count(d).alias("observations"),
        round_half_away(F.avg(d)).alias("mean_delay_seconds"),
    )
