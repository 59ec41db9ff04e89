"""Registered queries: (spark, sf_dir) -> DataFrame over the driver's tables.

Each query reads whole tables through the adapters in
``tramline.sources.testdata``; ``tramline.oracle`` holds its SQL twin.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tramline.functions.time import interval_text
from tramline.oracle import AS_OF, FINAL_DELAY_HOURS, SPARSE_THRESHOLD
from tramline.plans import marts, staging
from tramline.session import configure
from tramline.sources import testdata as td

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(name: str):
    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)
            return fn(spark, sf_dir)
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        REGISTRY[name] = run
        return run
    return register


# --- staging ----------------------------------------------------------------
def _stg_positions(spark, d):
    return staging.stg_vehicle_positions(td.positions(spark, d))


def _stg_weather(spark, d):
    return staging.stg_weather(td.weather(spark, d))


def _stg_trip_updates(spark, d):
    return staging.stg_trip_updates(td.trip_updates(spark, d), td.trips(spark, d))


def _stg_alerts(spark, d):
    return staging.stg_alerts(td.alerts(spark, d), as_of=AS_OF)


def _stg_routes(spark, d):
    return staging.stg_routes(td.routes(spark, d))


def _stg_stops(spark, d):
    return staging.stg_stops(td.stops(spark, d))


@query("stg_vehicle_positions")
def q_stg_vehicle_positions(spark, d):
    """MOD-1, FIL-1, FIL-9, FN-1..5."""
    return _stg_positions(spark, d)


@query("stg_weather")
def q_stg_weather(spark, d):
    """MOD-2, WIN-6, FN-15, FIL-5, FIL-8."""
    return _stg_weather(spark, d)


@query("stg_trip_updates")
def q_stg_trip_updates(spark, d):
    """MOD-3, JOIN-1, WIN-1..5, PRJ-1/2, FN-13."""
    return _stg_trip_updates(spark, d)


@query("stg_alerts")
def q_stg_alerts(spark, d):
    """MOD-4, FN-7..10, FN-16, AGG-9/10/13 (intervals as text and as seconds)."""
    return _stg_alerts(spark, d).withColumns({c: interval_text(c) for c in ("planned_duration", "observed_duration")})


@query("stg_routes")
def q_stg_routes(spark, d):
    """MOD-5, FN-9, FN-12, FN-14, FN-25, FIL-7."""
    return _stg_routes(spark, d)


@query("stg_stops")
def q_stg_stops(spark, d):
    """MOD-6, FN-11, FN-13, FIL-3."""
    return _stg_stops(spark, d)


# --- marts --------------------------------------------------------------------
@query("route_performance")
def q_route_performance(spark, d):
    """MOD-7: JOIN-2, AGG-1..3, AGG-5..9, FN-17/18."""
    return marts.fct_route_performance(_stg_trip_updates(spark, d), _stg_routes(spark, d))


@query("hourly_service")
def q_hourly_service(spark, d):
    """MOD-8: JOIN-3, AGG-4, AGG-11/12, SRT-1, FN-6, FN-19, DQ-5."""
    return marts.fct_hourly_service(
        _stg_positions(spark, d), _stg_trip_updates(spark, d), _stg_weather(spark, d),
        sparse_threshold=SPARSE_THRESHOLD,
    )


@query("alert_impact")
def q_alert_impact(spark, d):
    """MOD-9: JOIN-2, JOIN-4, G-19..21, G-27."""
    impact = marts.fct_alert_impact(_stg_alerts(spark, d), _stg_routes(spark, d))
    return impact.withColumn("planned_duration", interval_text("planned_duration"))


# --- ad-hoc reports -------------------------------------------------------------
from pyspark.sql import functions as F  # noqa: E402

from tramline.operators import sinks, upsert  # noqa: E402
from tramline.plans import adhoc  # noqa: E402
from tramline.session import scratch_dir  # noqa: E402
from tramline.sources import feeds, gtfs  # noqa: E402


@query("fleet_curve")
def q_fleet_curve(spark, d):
    """MOD-10: distinct active vehicles per UTC hour."""
    return adhoc.fleet_curve(_stg_positions(spark, d))


@query("effect_share")
def q_effect_share(spark, d):
    """MOD-10, AGG-16: active alerts by effect with their share."""
    return adhoc.effect_share(_stg_alerts(spark, d))


@query("gps_dropout")
def q_gps_dropout(spark, d):
    """MOD-10, DQ-6: share of positions without a GPS fix."""
    return adhoc.gps_dropout(td.positions(spark, d))


@query("mean_delay")
def q_mean_delay(spark, d):
    """MOD-10: mean arrival delay."""
    return adhoc.mean_delay(td.trip_updates(spark, d))


# --- feed flattening ----------------------------------------------------------------
@query("flatten_positions")
def q_flatten_positions(spark, d):
    """SRC-1, SRC-11: nested vehicle snapshots -> landed rows."""
    return feeds.flatten_vehicle_positions(td.vehicle_feed(spark, d))


@query("flatten_trip_updates")
def q_flatten_trip_updates(spark, d):
    """SRC-2, FN-24, PRJ-3: nested trip snapshots -> one row per stop update."""
    return feeds.flatten_trip_updates(td.trip_feed(spark, d))


@query("flatten_alerts")
def q_flatten_alerts(spark, d):
    """SRC-3, FN-20..23: nested alert snapshots -> one row per informed entity."""
    return feeds.flatten_alerts(td.alert_feed(spark, d))


@query("flatten_weather")
def q_flatten_weather(spark, d):
    """SRC-4: weather JSON records written, read back with a schema, flattened."""
    path = scratch_dir(spark, "weather-json")
    td.weather_records(spark, d).write.mode("overwrite").option(
        "timestampNTZFormat", feeds.JSON_NTZ_FORMAT).json(path)
    return feeds.flatten_weather(feeds.read_weather_json(spark, path))


@query("row_id")
def q_row_id(spark, d):
    """SRC-11: snapshot row ids are unique (rows vs distinct ids)."""
    flat = feeds.flatten_vehicle_positions(td.vehicle_feed(spark, d))
    return flat.agg(F.count(F.lit(1)).alias("row_count"),
                    F.count_distinct("id").alias("distinct_ids"))


# --- reference CSV ------------------------------------------------------------------
@query("csv_reference")
def q_csv_reference(spark, d):
    """SRC-5, SRC-7, SRC-9: timetable files written as CSV, loaded back by
    header (absent files skipped), stamped with loaded_at."""
    root = scratch_dir(spark, "gtfs")
    gtfs.write_csv(td.stops(spark, d).drop("loaded_at"), f"{root}/stops.txt")
    gtfs.write_csv(td.routes(spark, d).drop("loaded_at"), f"{root}/routes.txt")
    tables, skipped = gtfs.load_feed(spark, root, loaded_at=td.LOADED_AT)
    assert "trips.txt" in skipped and "gtfs_stops" in tables
    return tables["gtfs_stops"]


@query("csv_bulk")
def q_csv_bulk(spark, d):
    """SRC-6: large-file CSV rules (unquoted blank -> null, quoted blank -> '')."""
    root = scratch_dir(spark, "gtfs-bulk")
    gtfs.write_csv(td.stop_times(spark, d), f"{root}/stop_times.txt")
    tables, _ = gtfs.load_feed(spark, root, loaded_at=td.LOADED_AT)
    return tables["gtfs_stop_times"]


# --- sinks and maintenance ----------------------------------------------------------
SPLIT = "2024-01-16 00:00:00"  # batch 1 = before, batch 2 = from this time on


def _split(df, col="fetched_at"):
    """Both halves; rows without a time go with the first."""
    t = F.to_timestamp_ntz(F.lit(SPLIT))
    return df.where(F.col(col).isNull() | (F.col(col) < t)), df.where(F.col(col) >= t)


@query("append_snapshots")
def q_append_snapshots(spark, d):
    """SRC-8: two snapshot batches appended, partitioned by fetch date."""
    path = scratch_dir(spark, "positions")
    for batch in _split(td.positions(spark, d)):
        sinks.append_snapshot(batch, path)
    return sinks.read_landed(spark, path)


# The alert table's first layout, before the fingerprint and sighting columns.
OLD_ALERT_COLUMNS = ["id", "alert_id", "cause", "effect", "severity_level", "header_text",
                     "description_text", "url", "active_period_start", "active_period_end",
                     "informed_route_id", "informed_stop_id", "informed_trip_id", "fetched_at"]


@query("evolve_schema")
def q_evolve_schema(spark, d):
    """SRC-10: old-layout batch (no hash/first/last/times) then new layout in
    one table; read merged, times_seen defaulting to 1."""
    path = scratch_dir(spark, "alerts-evolving")
    old, new = _split(td.alerts(spark, d))
    sinks.append_snapshot(old.select(*OLD_ALERT_COLUMNS), path)
    sinks.append_snapshot(new, path)
    return sinks.evolve(sinks.read_landed(spark, path), {"times_seen": 1})


@query("full_refresh")
def q_full_refresh(spark, d):
    """SRC-9: two full loads of a reference table; readers see the newest."""
    path = scratch_dir(spark, "gtfs-stops")
    sinks.full_refresh(td.stops(spark, d).drop("loaded_at"), path, "2024-01-01 00:00:00", 1)
    sinks.full_refresh(td.stops(spark, d).drop("loaded_at"), path, td.RELOADED_AT, 2)
    return sinks.read_current(spark, path)


@query("row_counts")
def q_row_counts(spark, d):
    """SRC-14, SET-1: row counts of the landed and reference tables."""
    return sinks.row_counts({
        "positions": td.positions(spark, d), "trip_updates": td.trip_updates(spark, d),
        "alerts": td.alerts(spark, d), "weather": td.weather(spark, d),
        "routes": td.routes(spark, d), "stops": td.stops(spark, d), "trips": td.trips(spark, d),
    })


@query("keyed_layout_join")
def q_keyed_layout_join(spark, d):
    """SRC-17: trip updates and trips stored bucketed by trip_id, joined
    without a shuffle."""
    root = scratch_dir(spark, "keyed")
    tag = root.rstrip("/").rsplit("-", 1)[-1]
    tu = sinks.write_keyed_layout(td.trip_updates(spark, d), f"tl_trip_updates_{tag}",
                                  f"{root}/trip_updates", "trip_id")
    tr = sinks.write_keyed_layout(td.trips(spark, d), f"tl_trips_{tag}", f"{root}/trips",
                                  "trip_id")
    return tu.join(tr.select("trip_id", "route_id"), "trip_id", "left").select(
        "id", "trip_id", "stop_sequence", tr["route_id"])


@query("alert_upsert")
def q_alert_upsert(spark, d):
    """SRC-12, AGG-15: batch 1, batch 2 and batch 2 again (a retry) upserted; the first
    is compacted meanwhile. The retry is of a batch in the log, then of one in the base."""
    store = sinks.alert_fold_table(spark, scratch_dir(spark, "alert-state"))
    first, second = _split(td.alerts(spark, d))
    store.append(first, 1)
    store.compact()
    store.append(second, 2)
    store.append(second, 2)
    store.append(first, 1)
    return store.read()


@query("backfill_job")
def q_backfill_job(spark, d):
    """SRC-15/16: the one-off migration, stored and read back."""
    a = td.alerts(spark, d)
    old = a.withColumn("content_hash", F.when(F.col("first_seen_at").isNotNull(), F.col("content_hash")))
    path = scratch_dir(spark, "alert-backfill")
    upsert.backfill(old).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@query("upsert_outcome")
def q_upsert_outcome(spark, d):
    """SRC-13: rows of batch 2 inserted vs refreshing keys of batch 1."""
    first, second = _split(td.alerts(spark, d))
    return upsert.upsert_outcome(first, second)


@query("content_hash")
def q_content_hash(spark, d):
    """FN-20, SRC-15: legacy rows lose their fingerprint; the backfill restores it."""
    a = td.alerts(spark, d)
    a = a.withColumn("content_hash", F.when(F.col("first_seen_at").isNotNull(),
                                            F.col("content_hash")))
    return upsert.backfill_hashes(a).select("id", "content_hash")


@query("collapse_duplicates")
def q_collapse_duplicates(spark, d):
    """SRC-16: one survivor per key with first/last fetch and row count."""
    return upsert.collapse_duplicates(td.alerts(spark, d))


@query("survivor_update")
def q_survivor_update(spark, d):
    """JOIN-5: survivors annotated through an update-from-join."""
    return upsert.survivor_update(td.alerts(spark, d))


@query("anti_join_dedup")
def q_anti_join_dedup(spark, d):
    """JOIN-6: rows the dedup deletes (anti join on the survivor ids)."""
    return upsert.duplicate_rows(td.alerts(spark, d))


# --- data quality -------------------------------------------------------------------
from tramline.operators import quality  # noqa: E402


def _models(spark, d, test):
    """The models that have a check of this kind."""
    cat = testdata_catalog(spark, d)
    return {n: cat.ref(n) for n in dict.fromkeys(c.model for c in quality.SUITE if c.test == test)}


@query("dq_not_null")
def q_dq_not_null(spark, d):
    """DQ-1: the 30 not-null checks."""
    return quality.run_suite(_models(spark, d, "not_null"), tests=["not_null"])


@query("dq_unique")
def q_dq_unique(spark, d):
    """DQ-2: the 6 uniqueness checks."""
    return quality.run_suite(_models(spark, d, "unique"), tests=["unique"])


@query("dq_accepted_values")
def q_dq_accepted_values(spark, d):
    """DQ-3: the 3 accepted-values checks."""
    return quality.run_suite(_models(spark, d, "accepted_values"), tests=["accepted_values"])


@query("dq_suite")
def q_dq_suite(spark, d):
    """DQ-4: the scheduled run. Every model is stored once, its row checks observed while
    it is written; uniqueness is checked on the stored tables."""
    from tramline.plans.catalog import run_models_and_tests
    return run_models_and_tests(testdata_catalog(spark, d), scratch_dir(spark, "models"), fail=False)


@query("sparse_hours")
def q_sparse_hours(spark, d):
    """DQ-5: hours with fewer position reports than the threshold."""
    h = marts.fct_hourly_service(_stg_positions(spark, d), _stg_trip_updates(spark, d),
                                 _stg_weather(spark, d), sparse_threshold=SPARSE_THRESHOLD)
    return h.where(F.col("is_sparse_hour")).select("hour_bucket", "position_reports")


# --- streaming ----------------------------------------------------------------------
from tramline.streaming import jobs  # noqa: E402

STREAM_CHUNKS = 3


def _time_chunks(df, col: str, n: int = STREAM_CHUNKS):
    """Split rows into ``n`` consecutive time ranges (bounds from one small aggregate);
    rows without a time go with the first."""
    lo, hi = df.agg(F.min(col), F.max(col)).first()
    if lo is None:
        return [df]
    cuts = [None, *[lo + (hi - lo) / n * i for i in range(1, n)], None]
    return [df.where((F.lit(True) if a is None else F.col(col) >= F.lit(a))
                     & (F.lit(True) if b is None else F.col(col) < F.lit(b))
                     | (F.lit(a is None) & F.col(col).isNull()))
            for a, b in zip(cuts[:-1], cuts[1:])]


def _deliver(spark, name: str, chunks, start):
    """Land each chunk under a fresh folder, then run the stream with availableNow from
    the same checkpoint: one restart per delivery. ``start(stream, root)`` runs it."""
    root = scratch_dir(spark, name)
    for i, chunk in enumerate(chunks):
        chunk.write.mode("overwrite").parquet(f"{root}/source/delivery_{i:03d}")
        start(jobs.file_stream(spark, f"{root}/source/*", chunk.schema), root)
    return root


def _shuffled(chunks):
    """The last delivery first, the first one last: most rows come late."""
    return [chunks[-1], *chunks[1:-1], chunks[0]] if len(chunks) > 1 else chunks


@query("stream_flatten")
def q_stream_flatten(spark, d):
    """STR-1: vehicle snapshots flattened incrementally into an append sink."""
    root = _deliver(spark, "stream-flatten", _time_chunks(td.vehicle_feed(spark, d), "fetched_at"),
                    lambda s, r: jobs.append_to_files(jobs.flatten_stream(s, feeds.flatten_vehicle_positions),
                                                      f"{r}/sink", f"{r}/checkpoint"))
    return spark.read.parquet(f"{root}/sink")


def _folded(spark, name, chunks, make_log):
    """A fold log fed with late deliveries, compacted on the way."""
    root = _deliver(spark, name, _shuffled(chunks),
                    lambda s, r: jobs.fold_batches(s, make_log(spark, f"{r}/state"), f"{r}/checkpoint", compact_every=2))
    return make_log(spark, f"{root}/state")


@query("stream_alert_fold")
def q_stream_alert_fold(spark, d):
    """STR-2: alert sightings folded as running state, delivered out of order."""
    return _folded(spark, "stream-alert-fold", _time_chunks(td.alerts(spark, d), "fetched_at"), jobs.alert_folds).read()


@query("stream_weather_latest")
def q_stream_weather_latest(spark, d):
    """STR-3: latest fetch per observation time as running state, delivered out of order."""
    return _folded(spark, "stream-weather", _time_chunks(td.weather(spark, d), "fetched_at"), jobs.latest_weather).read()


@query("stream_hourly_fleet")
def q_stream_hourly_fleet(spark, d):
    """STR-4: per-hour active vehicles and reports, delivered out of order."""
    return jobs.read_hourly_fleet(_folded(
        spark, "stream-fleet", _time_chunks(td.positions(spark, d), "fetched_at"), jobs.hourly_fleet))


@query("stream_hourly_fleet_final")
def q_stream_hourly_fleet_final(spark, d):
    """STR-4: the later half of the reports first, then the earlier one. Hours the watermark has
    passed are final; what came for them afterwards is counted as late, and not lost."""
    first, second = _split(td.positions(spark, d))

    def start(stream, root):
        again = jobs.file_stream(spark, f"{root}/source/*", second.schema)
        jobs.fold_batches(stream, jobs.hourly_fleet(spark, f"{root}/state"), f"{root}/checkpoint")
        jobs.close_hours(again, jobs.hour_closings(spark, f"{root}/final"), f"{root}/checkpoint-final",
                         delay=f"{FINAL_DELAY_HOURS} hours")
    root = _deliver(spark, "stream-final", [second, first], start)
    return jobs.read_hourly_fleet(jobs.hourly_fleet(spark, f"{root}/state"), jobs.hour_closings(spark, f"{root}/final"))


@query("stream_enrich")
def q_stream_enrich(spark, d):
    """STR-5: stream of predictions left-joined to the published trip table, which is published
    anew before each delivery."""
    trips = td.trips(spark, d)
    home = scratch_dir(spark, "stream-trips")
    table = jobs.PublishedTable(spark, home)
    versions = iter((1, 2, 3))

    def start(stream, root):
        sinks.publish_keyed(trips, home, "trip_id", next(versions))
        jobs.enrich_batches(stream, table, f"{root}/sink", f"{root}/checkpoint")
    root = _deliver(spark, "stream-enrich", _time_chunks(td.trip_updates(spark, d), "fetched_at"), start)
    return spark.read.parquet(f"{root}/sink").select("id", "trip_id", "stop_sequence", "route_id")


@query("stream_replay")
def q_stream_replay(spark, d):
    """STR-6: the last delivery comes first, and again at the end, and the first one twice in
    between; every row is landed once."""
    chunks = _time_chunks(td.vehicle_feed(spark, d), "fetched_at")
    root = _deliver(spark, "stream-replay", [chunks[-1], *chunks, chunks[0], chunks[-1]],
                    lambda s, r: jobs.append_new_rows(feeds.flatten_vehicle_positions(s), f"{r}/sink", f"{r}/checkpoint"))
    return jobs.read_rows(spark, f"{root}/sink")


# --- named models -------------------------------------------------------------------
from tramline.plans.catalog import ModelCatalog, default_models  # noqa: E402


def testdata_catalog(spark, d, sparse_threshold: int = SPARSE_THRESHOLD) -> ModelCatalog:
    sources = {
        "raw_vehicle_positions": td.positions(spark, d), "raw_weather": td.weather(spark, d),
        "raw_trip_updates": td.trip_updates(spark, d), "raw_alerts": td.alerts(spark, d),
        "gtfs_routes": td.routes(spark, d), "gtfs_stops": td.stops(spark, d),
        "gtfs_trips": td.trips(spark, d),
    }
    return ModelCatalog(spark, sources,
                        default_models(as_of=AS_OF, sparse_threshold=sparse_threshold))


@query("named_models")
def q_named_models(spark, d):
    """SRC-18: models referenced by name and queried through SQL views."""
    cat = testdata_catalog(spark, d)
    cat.register_views(["fct_route_performance", "stg_routes"])
    return spark.sql(
        "SELECT p.route_id, r.route_mode, p.observations, p.median_delay_seconds "
        "FROM fct_route_performance p JOIN stg_routes r ON p.route_id = r.route_id")


@query("dq_alert_grain")
def q_dq_alert_grain(spark, d):
    """G-19: (route, alert) pairs that repeat in the impact mart."""
    impact = marts.fct_alert_impact(_stg_alerts(spark, d), _stg_routes(spark, d))
    return quality.unique_combination_failures(impact, ["route_id", "alert_id"])


@query("alert_unmatched_routes")
def q_alert_unmatched_routes(spark, d):
    """G-27: route-level alerts the impact mart drops for an unknown route."""
    return marts.unmatched_route_alerts(_stg_alerts(spark, d), _stg_routes(spark, d))


# --- single-function checks over whole tables ----------------------------------------
from tramline.functions import time as T  # noqa: E402
from tramline.functions.numeric import round_half_away, round_half_even  # noqa: E402
from tramline.operators.windows import observation_history  # noqa: E402


@query("fn_time_parts")
def q_fn_time_parts(spark, d):
    """FN-1..6: epoch round trip, local time and its parts for every event."""
    e = td.table(spark, d, "events")
    local = T.to_local("ts")
    return e.select(
        "event_id",
        T.epoch_to_utc(T.utc_seconds("ts")).alias("ts_seconds"),
        local.alias("ts_local"),
        T.hour_of(local).alias("local_hour"),
        T.day_of_week(local).alias("local_day_of_week"),
        T.day_name(local).alias("local_day_name"),
        T.hour_bucket(local).alias("local_hour_bucket"),
    )


@query("win_event_history")
def q_win_event_history(spark, d):
    """WIN-1..5: observation history of every user's events (ts, event_id order)."""
    e = td.table(spark, d, "events").select("event_id", "user_id", "ts", "value")
    h = observation_history(e, ["user_id"], ["ts", "event_id"], "value")
    return h.select("event_id", "user_id", "observation_number", "total_observations",
                    "recency_rank", F.col("previous_value").alias("previous_value"),
                    F.col("first_value").alias("first_value"))


@query("win_event_history_split")
def q_win_event_history_split(spark, d):
    """WIN-1..5 with every key cut at the borders of global ranges: the same rows."""
    e = td.table(spark, d, "events").select("event_id", "user_id", "ts", "value")
    return observation_history(e, ["user_id"], ["ts", "event_id"], "value", split=True, ranges=13).drop("ts", "value")


@query("trip_history_slices")
def q_trip_history_slices(spark, d):
    """MOD-3, WIN-1..5: the prediction history kept in slices, by year here as the test data
    spreads few rows over many. All but one are made first and that one, in the middle,
    comes late; no slice reads another's raw rows."""
    raw = staging.trip_observations(td.trip_updates(spark, d)).withColumn("fetch_date", F.to_date("fetched_at"))
    history = staging.trip_history(spark, scratch_dir(spark, "trip-history"), grain="year")
    years = [r[0] for r in raw.select(history.slice_of(F.col("fetch_date")).alias("y")).distinct().sort("y").collect()]
    late = years[len(years) // 2:][:1]
    history.update(raw, [x for x in years if x not in late])
    history.update(raw, late)
    return staging.stg_trip_updates_from(history, td.trips(spark, d))


@query("agg_event_stats")
def q_agg_event_stats(spark, d):
    """AGG-1/2/7/8/12 per event type: counts, distinct users, exact percentiles
    (half-even), mode with ties to the smallest, sample stddev."""
    e = td.table(spark, d, "events").withColumn("k", td.k_of())
    return e.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("events"),
        F.count_distinct("user_id").alias("users"),
        round_half_even(F.percentile("k", 0.5)).alias("median_k"),
        round_half_even(F.percentile("k", 0.9)).alias("p90_k"),
        F.mode("k", deterministic=True).alias("mode_k"),
        round_half_away(F.stddev_samp("k"), 3).alias("stddev_k"),
    )


@query("fn_codes")
def q_fn_codes(spark, d):
    """FN-9, FN-11..15, FN-25: code maps and blank handling on every part."""
    from tramline.functions import codes
    from tramline.functions.text import blank_to_null, text_to_double

    p = td.table(spark, d, "part")
    size = F.col("p_size")
    rid = F.concat(F.col("p_partkey").cast("string"),
                   codes.lookup(F.col("p_partkey") % 4, [(0, "U"), (1, "E"), (2, "X")], ""))
    short = F.concat("p_brand", F.when(size % 7 == 0, F.lit("N")).otherwise(F.lit("")))
    return p.select(
        "p_partkey",
        codes.route_mode((size % 12).cast("string")).alias("route_mode"),
        codes.service_area(rid).alias("service_area"),
        codes.is_night_route(short).alias("is_night_route"),
        codes.weather_condition(size * 2).alias("weather_condition"),
        codes.feed_accessibility((size % 4).cast("string")).alias("feed_accessible"),
        codes.stop_boarding((size % 4).cast("string")).alias("stop_accessible"),
        blank_to_null(F.when(size % 5 == 0, F.lit("")).otherwise(F.col("p_type"))).alias("p_type_or_null"),
        text_to_double(F.when(size % 6 == 0, F.lit("")).otherwise(
            F.col("p_retailprice").cast("string"))).alias("price"),
    )
