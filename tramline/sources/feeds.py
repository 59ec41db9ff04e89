"""Flatten nested feed snapshots into landed rows (SRC-1..4, SRC-11, PRJ-3).

Every function is a pure ``DataFrame -> DataFrame`` projection: explode
happens per row inside a task, nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tramline.functions import codes
from tramline.functions.text import content_hash, pick_translation
from tramline.functions.time import utc_micros
from tramline.schemas import ALERT_CONTENT, WEATHER_FEED

# FIXED VALUE: microseconds from year 1 to 1970, so that no time in a row id is negative.
YEAR_ONE_MICROS = 62_135_596_800_000_000


def snapshot_row_id(fetched_at, entity, sub=None) -> Column:
    """Surrogate row id (SRC-11): the snapshot's time in microseconds, the entity's place
    in it and the place within the entity, as padded digits.

    Unique for snapshots that differ by a microsecond and for any number of entities, and
    the same when a snapshot is delivered again. As text of one length it sorts like the
    numbers; nothing is packed, so nothing overflows.
    """
    ts = F.col(fetched_at) if isinstance(fetched_at, str) else fetched_at
    parts = [(utc_micros(ts) + F.lit(YEAR_ONE_MICROS), 18), (entity, 10), (F.lit(0) if sub is None else sub, 10)]
    return F.concat(*[F.lpad(x.cast("string"), n, "0") for x, n in parts])


def _str(c: Column) -> Column:
    """Unset proto string -> ''."""
    return F.coalesce(c, F.lit(""))


def _num(c: Column, zero=0) -> Column:
    """Unset proto number -> 0."""
    return F.coalesce(c, F.lit(zero))


def flatten_vehicle_positions(feed: DataFrame) -> DataFrame:
    """Vehicle snapshot -> one row per entity carrying a vehicle (SRC-1)."""
    e = feed.select("fetched_at", F.posexplode("entity").alias("pos", "e"))
    v = F.col("e.vehicle")
    return e.where(v.isNotNull()).select(
        snapshot_row_id("fetched_at", F.col("pos")).alias("id"),
        _str(v["vehicle"]["id"]).alias("vehicle_id"),
        _str(v["vehicle"]["label"]).alias("vehicle_label"),
        _str(v["trip"]["route_id"]).alias("route_id"),
        _str(v["trip"]["trip_id"]).alias("trip_id"),
        _str(v["trip"]["start_time"]).alias("trip_start_time"),
        _str(v["trip"]["start_date"]).alias("trip_start_date"),
        _num(v["position"]["latitude"], 0.0).cast("double").alias("latitude"),
        _num(v["position"]["longitude"], 0.0).cast("double").alias("longitude"),
        _num(v["position"]["bearing"], 0.0).cast("double").alias("bearing"),
        _num(v["timestamp"]).cast("long").alias("gps_timestamp"),
        F.col("fetched_at"),
    )


def flatten_trip_updates(feed: DataFrame) -> DataFrame:
    """Trip snapshot -> one row per stop-time update (SRC-2).

    A trip update without stop updates yields nothing; a delay is null when
    its arrival/departure sub-message is absent, 0 when present but unset.
    """
    e = feed.select("fetched_at", F.posexplode("entity").alias("pos", "e")).where(
        F.col("e.trip_update").isNotNull()
    )
    s = e.select(
        "fetched_at", "pos", F.col("e.trip_update").alias("tu"),
        F.posexplode("e.trip_update.stop_time_update").alias("spos", "stu"),
    )
    tu, stu = F.col("tu"), F.col("stu")

    def delay(event: str) -> Column:
        return F.when(stu[event].isNotNull(), _num(stu[event]["delay"])).cast("int")

    return s.select(
        snapshot_row_id("fetched_at", F.col("pos"), F.col("spos")).alias("id"),
        _str(tu["trip"]["trip_id"]).alias("trip_id"),
        _str(tu["trip"]["route_id"]).alias("route_id"),
        _str(tu["trip"]["start_time"]).alias("trip_start_time"),
        _str(tu["trip"]["start_date"]).alias("trip_start_date"),
        _str(tu["vehicle"]["id"]).alias("vehicle_id"),
        _str(tu["vehicle"]["label"]).alias("vehicle_label"),
        _str(tu["vehicle"]["license_plate"]).alias("license_plate"),
        _num(tu["vehicle"]["wheelchair_accessible"]).cast("string").alias("wheelchair_accessible"),
        _num(stu["stop_sequence"]).cast("int").alias("stop_sequence"),
        delay("arrival").alias("arrival_delay_seconds"),
        delay("departure").alias("departure_delay_seconds"),
        _num(tu["timestamp"]).cast("long").alias("gps_timestamp"),
        F.col("fetched_at"),
    )


def flatten_alerts(feed: DataFrame, strict_enums: bool = True, language: str = "it") -> DataFrame:
    """Alert snapshot -> one row per informed entity (SRC-3).

    An alert naming no entity yields one row with null entity columns. The
    content fingerprint covers the eight content fields (FN-20). Each row is
    a first sighting: first_seen_at = last_seen_at = fetched_at, times_seen 1.
    """
    e = feed.select("fetched_at", F.posexplode("entity").alias("pos", "e")).where(
        F.col("e.alert").isNotNull()
    )
    a = F.col("e.alert")
    period = F.get(a["active_period"], 0)
    has_period = period.isNotNull()
    content = e.select(
        "fetched_at", "pos",
        F.col("e.id").alias("alert_id"),
        codes.cause_name(a["cause"], strict_enums).alias("cause"),
        codes.effect_name(a["effect"], strict_enums).alias("effect"),
        codes.severity_name(a["severity_level"], strict_enums).alias("severity_level"),
        pick_translation(a["header_text"]["translation"], language).alias("header_text"),
        pick_translation(a["description_text"]["translation"], language).alias("description_text"),
        pick_translation(a["url"]["translation"], language).alias("url"),
        F.when(has_period, _num(period["start"])).cast("long").alias("active_period_start"),
        F.when(has_period, _num(period["end"])).cast("long").alias("active_period_end"),
        a["informed_entity"].alias("ies"),
    ).withColumn("content_hash", content_hash(*ALERT_CONTENT))
    rows = content.select("*", F.posexplode_outer("ies").alias("ipos", "ie"))
    ie = F.col("ie")
    return rows.select(
        snapshot_row_id(
            "fetched_at", F.col("pos"), F.coalesce(F.col("ipos"), F.lit(0))
        ).alias("id"),
        "alert_id", "content_hash", *ALERT_CONTENT[:6],
        "active_period_start", "active_period_end",
        F.nullif(ie["route_id"], F.lit("")).alias("informed_route_id"),
        F.nullif(ie["stop_id"], F.lit("")).alias("informed_stop_id"),
        F.nullif(ie["trip"]["trip_id"], F.lit("")).alias("informed_trip_id"),
        F.col("fetched_at").alias("first_seen_at"),
        F.col("fetched_at").alias("last_seen_at"),
        F.lit(1).alias("times_seen"),
        "fetched_at",
    )


def flatten_weather(feed: DataFrame) -> DataFrame:
    """Weather JSON record -> one row (SRC-4). ``time`` is UTC ISO minutes."""
    c = F.col("current")
    return feed.select(
        snapshot_row_id("fetched_at", F.lit(0)).alias("id"),
        F.to_timestamp_ntz(c["time"], F.lit("yyyy-MM-dd'T'HH:mm")).alias("observed_at"),
        c["temperature_2m"].cast("double").alias("temperature_c"),
        c["precipitation"].cast("double").alias("precipitation_mm"),
        c["wind_speed_10m"].cast("double").alias("wind_speed_kmh"),
        c["weather_code"].cast("int").alias("weather_code"),
        "fetched_at",
    )


JSON_NTZ_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def read_weather_json(spark, path: str) -> DataFrame:
    """Read landed weather JSON records with a fixed schema (no inference)."""
    return (spark.read.schema(WEATHER_FEED).option("timestampNTZFormat", JSON_NTZ_FORMAT)
            .json(path))
