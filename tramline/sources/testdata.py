"""Adapters from the driver's test tables to the transit source shapes.

Each adapter reads whole tables and is a pure projection or a bounded
aggregation, so its work grows with the input. ``tramline.oracle`` holds
the same rules as DuckDB SQL; the two must change together.

Rules (``k`` = the integer in ``events.props``):
  positions     <- events: one position per event
  weather       <- events: observed_at = ts floored to 15 minutes
  trip_updates  <- lineitem: one stop-time prediction per line
  trips         <- orders: route = (custkey % 60) + suffix U/E/X by (n % 3)
  routes        <- part: one route per partkey % 50 (the smallest part in it)
  stops         <- customer
  alerts        <- events: one landed alert row per event
"""

from __future__ import annotations

import os
import weakref

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline.functions import codes
from tramline.functions.text import content_hash
from tramline.functions.time import epoch_to_utc, utc_seconds
from tramline.schemas import ALERT_CONTENT

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")
# FIXED VALUES shared with the oracle SQL.
LOADED_AT = "2024-01-01 00:00:00"
RELOADED_AT = "2024-01-02 03:04:05"
SNAPSHOT_BASE_EPOCH = 1_704_067_200  # 2024-01-01T00:00:00Z, first nested snapshot
ROUTE_SUFFIXES = ["U", "E", "X"]  # by route number % 3
TRIP_ROUTES = 60  # trips use route numbers 0..59
ROUTE_COUNT = 50  # routes exist for numbers 0..49, so 50..59 stay unmatched


_READS: "weakref.WeakKeyDictionary[SparkSession, dict]" = weakref.WeakKeyDictionary()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The driver's table (read-only input). One base DataFrame per session and
    file, so the file listing and footer read happen once."""
    reads = _READS.setdefault(spark, {})
    key = (sf_dir, name)
    if key not in reads:
        reads[key] = spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
    return reads[key]


def k_of(props="props") -> Column:
    return F.get_json_object(F.col(props), "$.k").cast("int")


def route_id_of(n: Column) -> Column:
    """Route id in the routes form: number followed by a suffix by n % 3."""
    suffix = codes.lookup(n % 3, list(enumerate(ROUTE_SUFFIXES)))
    return F.concat(n.cast("string"), suffix)


def positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _positions(table(spark, sf_dir, "events").withColumn("k", k_of()))


def _positions(e: DataFrame, *extra: str) -> DataFrame:
    k, v = F.col("k"), F.col("value")
    return e.select(
        F.col("event_id").alias("id"),
        F.col("user_id").cast("string").alias("vehicle_id"),
        F.concat(F.lit("V"), F.col("user_id").cast("string")).alias("vehicle_label"),
        F.col("event_type").alias("route_id"),
        F.when(k % 10 == 0, F.lit("")).otherwise(k.cast("string")).alias("trip_id"),
        F.lit("").alias("trip_start_time"),
        F.date_format("ts", "yyyyMMdd").alias("trip_start_date"),
        F.when(k % 25 == 0, F.lit(0.0)).otherwise(F.lit(45.0) + v / 1000).alias("latitude"),
        F.when(k % 40 == 0, F.lit(0.0)).otherwise(F.lit(7.6) + v / 1000).alias("longitude"),
        (k.cast("double") * F.lit(3.6)).alias("bearing"),
        utc_seconds("ts").alias("gps_timestamp"),
        F.col("ts").alias("fetched_at"),
        *extra,
    )


def floor_15min(ts: str) -> Column:
    return epoch_to_utc(F.floor(utc_seconds(ts) / 900) * 900)


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").withColumn("k", k_of())
    k, v = F.col("k"), F.col("value")
    return e.select(
        F.col("event_id").alias("id"),
        floor_15min("ts").alias("observed_at"),
        (v / 10 - 5).alias("temperature_c"),
        F.when(k % 3 == 0, v / 100).otherwise(F.lit(0.0)).alias("precipitation_mm"),
        (k.cast("double") / 2).alias("wind_speed_kmh"),
        k.alias("weather_code"),
        F.col("ts").alias("fetched_at"),
    )


def line_id() -> Column:
    """Unique line id: order, line number, part, supplier and quantity as padded digits,
    which sort as the numbers do at any size."""
    parts = (("l_orderkey", 19), ("l_linenumber", 10), ("l_partkey", 19), ("l_suppkey", 19), ("l_quantity", 10))
    return F.concat(*[F.lpad(F.col(c).cast("long").cast("string"), n, "0") for c, n in parts])


def _delay(quantity: Column) -> Column:
    return ((quantity - 25) * 20).cast("int")


def trip_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    arrival = _delay(F.col("l_quantity"))
    return li.select(
        line_id().alias("id"),
        F.col("l_orderkey").cast("string").alias("trip_id"),
        F.lit("").alias("route_id"),
        F.lit("").alias("trip_start_time"),
        F.date_format("l_shipdate", "yyyyMMdd").alias("trip_start_date"),
        F.col("l_suppkey").cast("string").alias("vehicle_id"),
        F.lit("").alias("vehicle_label"),
        F.lit("").alias("license_plate"),
        codes.lookup("l_returnflag", [("A", "2"), ("R", "3")], "0").alias("wheelchair_accessible"),
        F.col("l_linenumber").alias("stop_sequence"),
        arrival.alias("arrival_delay_seconds"),
        F.when(F.col("l_returnflag") != "N", arrival + 30).alias("departure_delay_seconds"),
        utc_seconds("l_shipdate").alias("gps_timestamp"),
        F.col("l_shipdate").alias("fetched_at"),
    )


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    n = F.col("o_custkey") % TRIP_ROUTES
    return o.select(
        F.col("o_orderkey").cast("string").alias("trip_id"),
        route_id_of(n).alias("route_id"),
        F.lit("1").alias("service_id"),
        (F.col("o_orderkey") % 2).cast("string").alias("direction_id"),
        F.col("o_orderpriority").alias("trip_headsign"),
        F.to_timestamp_ntz(F.lit(LOADED_AT)).alias("loaded_at"),
    )


def routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One route per ``p_partkey % 50``, described by the smallest part in it."""
    p = table(spark, sf_dir, "part")
    grouped = p.groupBy((F.col("p_partkey") % ROUTE_COUNT).alias("n")).agg(
        F.min_by("p_brand", "p_partkey").alias("brand"),
        F.min_by("p_size", "p_partkey").alias("size"),
        F.min_by("p_name", "p_partkey").alias("name"),
        F.min_by("p_type", "p_partkey").alias("ptype"),
    )
    n = F.col("n")
    return grouped.select(
        route_id_of(n).alias("route_id"),
        F.lit("1").alias("agency_id"),
        F.concat(F.col("brand"), F.when(F.col("size") % 7 == 0, F.lit("N")).otherwise(F.lit("")))
        .alias("route_short_name"),
        F.col("name").alias("route_long_name"),
        F.col("ptype").alias("route_desc"),
        (n % 10).cast("string").alias("route_type"),
        F.lit("").alias("route_url"),
        F.when(n % 4 == 0, F.lit("")).otherwise(F.concat(F.lit("C"), n.cast("string")))
        .alias("route_color"),
        F.lit("").alias("route_text_color"),
        F.to_timestamp_ntz(F.lit(LOADED_AT)).alias("loaded_at"),
    )


def stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    return c.select(
        key.cast("string").alias("stop_id"),
        key.cast("string").alias("stop_code"),
        F.col("c_name").alias("stop_name"),
        F.col("c_mktsegment").alias("stop_desc"),
        F.when(key % 50 == 0, F.lit("")).otherwise(F.col("c_acctbal").cast("string"))
        .alias("stop_lat"),
        F.when(key % 70 == 0, F.lit("")).otherwise(F.col("c_nationkey").cast("string"))
        .alias("stop_lon"),
        F.col("c_nationkey").cast("string").alias("zone_id"),
        F.lit("").alias("stop_url"),
        F.lit("").alias("location_type"),
        F.lit("").alias("parent_station"),
        F.lit("").alias("stop_timezone"),
        (key % 3).cast("string").alias("wheelchair_boarding"),
        F.to_timestamp_ntz(F.lit(LOADED_AT)).alias("loaded_at"),
    )


def alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed alert rows: one per event, with legacy rows (no first/last/times)."""
    e = table(spark, sf_dir, "events").withColumn("k", k_of())
    k = F.col("k")
    start = utc_seconds(F.date_trunc("day", "ts").cast("timestamp_ntz"))
    legacy = k % 5 == 0
    rows = e.select(
        F.col("event_id").alias("id"),
        F.col("user_id").cast("string").alias("alert_id"),
        codes.lookup(k % 12 + 1, codes.ALERT_CAUSES).alias("cause"),
        codes.lookup(k % 11 + 1, codes.ALERT_EFFECTS).alias("effect"),
        codes.lookup(k % 4 + 1, codes.ALERT_SEVERITIES).alias("severity_level"),
        F.col("event_type").alias("header_text"),
        F.when(k % 6 != 0, F.concat(F.lit("about "), F.col("event_type"))).alias("description_text"),
        F.when(k % 2 == 0, F.concat(F.lit("alert-"), F.col("user_id").cast("string"))).alias("url"),
        start.alias("active_period_start"),
        F.when(k % 20 == 0, F.lit(0).cast("long")).otherwise(start + k * 3600).alias(
            "active_period_end"),
        F.when(k % 4 == 0, route_id_of(k % TRIP_ROUTES)).alias("informed_route_id"),
        # every 8th k names a stop next to its route (grain rule G-19)
        F.when((k % 4 == 1) | (k % 8 == 0), k.cast("string")).alias("informed_stop_id"),
        F.when(k % 4 == 2, k.cast("string")).alias("informed_trip_id"),
        F.when(~legacy, F.col("ts")).alias("first_seen_at"),
        F.when(~legacy, F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(0), k)).alias(
            "last_seen_at"),
        F.when(~legacy, k % 3 + 1).alias("times_seen"),
        F.col("ts").alias("fetched_at"),
    )
    return rows.withColumn("content_hash", content_hash(*ALERT_CONTENT)).select(
        "id", "alert_id", "content_hash", *ALERT_CONTENT, "informed_route_id", "informed_stop_id",
        "informed_trip_id", "first_seen_at", "last_seen_at", "times_seen", "fetched_at",
    )


# --- nested snapshots for the flatten operators --------------------------------
# Snapshots hold a bounded number of entities (consecutive ids), so no group
# grows with the table.
VEHICLE_SNAPSHOT = 20  # events per vehicle snapshot, 5 minutes apart
TRIP_SNAPSHOT = 20  # orders per trip snapshot, 5 minutes apart
ALERT_SNAPSHOT = 25  # events per alert snapshot, 15 minutes apart


def _snapshot_time(group: Column, step_seconds: int) -> Column:
    return epoch_to_utc(F.lit(SNAPSHOT_BASE_EPOCH) + group * step_seconds)


def _nest(rows: DataFrame, group: Column, order: Column, entity: Column, step: int) -> DataFrame:
    """Collect entities of each bounded group into one snapshot, in ``order``."""
    g = rows.select(group.alias("g"), F.struct(order.alias("o"), entity.alias("e")).alias("x"))
    snaps = g.groupBy("g").agg(F.sort_array(F.collect_list("x")).alias("xs"))
    return snaps.select(
        _snapshot_time(F.col("g"), step).alias("fetched_at"),
        F.transform("xs", lambda x: x["e"]).alias("entity"),
    )


def _null(type_name: str) -> Column:
    return F.lit(None).cast(type_name)


def vehicle_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One vehicle snapshot per 20 consecutive events; every 17th k has no vehicle,
    every 10th k no trip descriptor."""
    p = _positions(table(spark, sf_dir, "events").withColumn("k", k_of()), "k", "event_type")
    k = F.col("k")
    trip = F.when(k % 10 != 0, F.struct(
        k.cast("string").alias("trip_id"), F.col("event_type").alias("route_id"),
        _null("string").alias("start_time"), F.col("trip_start_date").alias("start_date")))
    vehicle = F.when(k % 17 != 0, F.struct(
        F.struct(F.col("vehicle_id").alias("id"), F.col("vehicle_label").alias("label"),
                 _null("string").alias("license_plate"),
                 _null("int").alias("wheelchair_accessible")).alias("vehicle"),
        trip.alias("trip"),
        F.struct("latitude", "longitude", "bearing").alias("position"),
        F.col("gps_timestamp").alias("timestamp")))
    entity = F.struct(F.col("id").cast("string").alias("id"), vehicle.alias("vehicle"))
    return _nest(p, (F.col("id") / VEHICLE_SNAPSHOT).cast("long"), F.col("id"), entity, 300)


def trip_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One trip update per order carrying its lines as stop-time updates;
    20 consecutive orders per snapshot."""
    li = table(spark, sf_dir, "lineitem")
    delay = _delay(F.col("l_quantity"))
    stu = F.struct(
        F.col("l_linenumber").alias("stop_sequence"),
        F.struct(delay.alias("delay")).alias("arrival"),
        F.when(F.col("l_returnflag") != "N", F.struct((delay + 30).alias("delay"))).alias(
            "departure"),
    )
    per_order = li.groupBy("l_orderkey").agg(F.sort_array(F.collect_list(F.struct(
        "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", stu.alias("stu")))).alias("lines"))
    o = table(spark, sf_dir, "orders").join(
        per_order, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    tu = F.struct(
        F.struct(F.col("o_orderkey").cast("string").alias("trip_id"),
                 _null("string").alias("route_id"), _null("string").alias("start_time"),
                 F.date_format("o_orderdate", "yyyyMMdd").alias("start_date")).alias("trip"),
        F.struct(F.col("o_custkey").cast("string").alias("id"), _null("string").alias("label"),
                 _null("string").alias("license_plate"),
                 (F.col("o_custkey") % 4).cast("int").alias("wheelchair_accessible")).alias(
            "vehicle"),
        utc_seconds("o_orderdate").alias("timestamp"),
        F.coalesce(F.transform("lines", lambda x: x["stu"]),
                   F.array().cast("array<struct<stop_sequence:int,arrival:struct<delay:int>,"
                                  "departure:struct<delay:int>>>")).alias("stop_time_update"),
    )
    entity = F.struct(F.col("o_orderkey").cast("string").alias("id"), tu.alias("trip_update"))
    return _nest(o, (F.col("o_orderkey") / TRIP_SNAPSHOT).cast("long"), F.col("o_orderkey"),
                 entity, 300)


def _translations(*pairs) -> Column:
    return F.array(*[F.struct(t.alias("text"), F.lit(lang).alias("language")) for t, lang in pairs])


def alert_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One alert entity per event; 25 consecutive events per snapshot. Covers
    preferred language second / only English / no translation, no period,
    two periods, unset enums, and entity lists of 0, 1 and 2 members."""
    e = table(spark, sf_dir, "events").withColumn("k", k_of())
    k, et = F.col("k"), F.col("event_type")
    start = utc_seconds(F.date_trunc("day", "ts").cast("timestamp_ntz"))
    end = start + k * 3600
    tr_type = "array<struct<text:string,language:string>>"
    header = (F.when(k % 3 == 0, _translations((F.concat(F.lit("EN "), et), "en"), (et, "it")))
              .when(k % 3 == 1, _translations((et, "en")))
              .otherwise(F.array().cast(tr_type)))
    period_t = "array<struct<start:bigint,end:bigint>>"
    periods = (F.when(k % 5 == 0, F.array().cast(period_t))
               .when(k % 5 == 1, F.array(F.struct(start.alias("start"), end.alias("end")),
                                         F.struct((start + 86400).alias("start"),
                                                  (end + 86400).alias("end"))))
               .otherwise(F.array(F.struct(start.alias("start"), end.alias("end")))))

    def ie(route=None, stop=None, trip=None) -> Column:
        return F.struct(
            (route if route is not None else _null("string")).alias("route_id"),
            (stop if stop is not None else _null("string")).alias("stop_id"),
            (F.struct(trip.alias("trip_id")) if trip is not None
             else _null("struct<trip_id:string>")).alias("trip"))

    route = route_id_of(k % TRIP_ROUTES)
    entities = (F.when(k % 4 == 0, F.array(ie(route=route)))
                .when(k % 4 == 1, F.array(ie(stop=k.cast("string")), ie(route=route)))
                .when(k % 4 == 2, F.array(ie(trip=k.cast("string"))))
                .otherwise(F.array().cast(
                    "array<struct<route_id:string,stop_id:string,trip:struct<trip_id:string>>>")))
    alert = F.struct(
        F.when(k % 9 != 0, k % 12 + 1).alias("cause"),
        (k % 11 + 1).alias("effect"),
        F.when(k % 7 != 0, k % 4 + 1).alias("severity_level"),
        F.struct(header.alias("translation")).alias("header_text"),
        F.when(k % 2 == 1, F.struct(_translations((F.concat(F.lit("about "), et), "it"))
                                    .alias("translation"))).alias("description_text"),
        _null(f"struct<translation:{tr_type}>").alias("url"),
        periods.alias("active_period"),
        entities.alias("informed_entity"),
    )
    entity = F.struct(F.col("user_id").cast("string").alias("id"), alert.alias("alert"))
    return _nest(e, (F.col("event_id") / ALERT_SNAPSHOT).cast("long"), F.col("event_id"), entity,
                 900)


def weather_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weather API records (one per event fetch) in the JSON source shape."""
    w = weather(spark, sf_dir)
    return w.select(
        "fetched_at",
        F.struct(
            F.date_format("observed_at", "yyyy-MM-dd'T'HH:mm").alias("time"),
            F.col("temperature_c").alias("temperature_2m"),
            F.col("precipitation_mm").alias("precipitation"),
            F.col("wind_speed_kmh").alias("wind_speed_10m"),
            F.col("weather_code").alias("weather_code"),
        ).alias("current"),
    )


def stop_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A large timetable file: one stop time per line item. Times are null
    (written unquoted-empty) for flag N and '' (quoted-empty) for flag R;
    headsigns carry quotes and commas."""
    li = table(spark, sf_dir, "lineitem")
    flag = F.col("l_returnflag")
    t = F.concat(F.lpad(F.col("l_linenumber").cast("string"), 2, "0"), F.lit(":00:00"))
    time_ = F.when(flag == "N", _null("string")).when(flag == "R", F.lit("")).otherwise(t)
    return li.select(
        F.col("l_orderkey").cast("string").alias("trip_id"),
        time_.alias("arrival_time"),
        time_.alias("departure_time"),
        F.col("l_partkey").cast("string").alias("stop_id"),
        F.col("l_linenumber").cast("string").alias("stop_sequence"),
        F.concat(F.lit('stop "'), F.col("l_suppkey").cast("string"), F.lit('", platform ')
                 , F.col("l_linestatus")).alias("stop_headsign"),
    )
