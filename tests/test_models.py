import contextlib
import datetime as dt
import io

from pyspark.sql import functions as F

import fixtures as fx
from conftest import rows
from tramline.plans import marts, staging

T = dt.datetime.fromisoformat


def stg_tu(spark):
    return staging.stg_trip_updates(fx.trip_updates(spark), fx.trips(spark))


def test_trip_update_history(spark):
    df = stg_tu(spark)
    got = {(r.trip_id, r.stop_sequence, r.fetched_at): r for r in df.collect()}
    a, b, c = (got[("T1", 2, T(f"2024-06-01 08:{m}:00"))] for m in ("00", "05", "10"))
    assert (a.observation_number, a.recency_rank, a.total_observations) == (1, 3, 3)
    assert (c.observation_number, c.recency_rank, c.is_latest_observation) == (3, 1, True)
    assert (b.previous_delay_seconds, b.delay_change_seconds, b.first_delay_seconds,
            b.delay_drift_seconds) == (-30, 120, -30, 120)
    # null delays are kept by lag and first_value
    n2 = got[("T1", 3, T("2024-06-01 08:05:00"))]
    n3 = got[("T1", 3, T("2024-06-01 08:10:00"))]
    assert n2.previous_delay_seconds == 120 and n2.delay_change_seconds is None
    assert n3.previous_delay_seconds is None and n3.first_delay_seconds == 120
    # G-3 tie broken by id; G-8 unmatched trip; G-2 history across service dates
    tie = sorted((r.recency_rank, r.arrival_delay_seconds) for r in df.collect()
                 if r.trip_id == "T2" and r.stop_sequence == 2)
    assert tie == [(1, 61), (2, 30)]
    assert got[("TX", 4, T("2024-06-01 09:00:00"))].route_id is None
    assert got[("T3", 5, T("2024-06-02 10:00:00"))].observation_number == 2
    # null stop_sequence dropped; en-route flag; accessibility decode; local time (summer +2)
    assert all(r.stop_sequence is not None for r in df.collect())
    assert [got[("T2", s, T("2024-06-01 09:00:00"))].is_en_route for s in (0, 1)] == [False, False]
    assert a.is_wheelchair_accessible is True and n2.is_wheelchair_accessible is False
    assert a.fetched_at_local == T("2024-06-01 10:00:00") and a.local_hour == 10
    assert a.local_day_name == "Saturday " and a.local_day_of_week == 6


def test_route_performance(spark):
    perf = marts.fct_route_performance(stg_tu(spark), staging.stg_routes(fx.routes(spark)))
    got = {r.route_id: r for r in perf.collect()}
    # G-1: (T1, 2) ends at 0 and drops; (T1, 3) ends at 200 -> R1U has one observation.
    r1 = got["R1U"]
    assert (r1.observations, r1.avg_delay_seconds, r1.stddev_delay_seconds) == (1, 200.0, None)
    assert (r1.pct_late, r1.pct_on_time, r1.pct_wheelchair_accessible) == (100.0, 0.0, 0.0)
    # R2E: (T2, 2) latest 61 and (T4, 2) 120 -> median 90.5 -> 90 (half even), mean 90.5 -> 91.
    r2 = got["R2E"]
    assert (r2.observations, r2.trips_observed) == (2, 2)
    assert (r2.median_delay_seconds, r2.avg_delay_seconds) == (90.0, 91.0)
    assert (r2.max_early_seconds, r2.max_late_seconds) == (61, 120)
    assert (r2.route_mode, r2.service_area, r2.is_night_route) == ("bus", "extra_urban", True)
    # R3 trips: the latest of (T3, 5) is -70 -> early.
    assert got["R3"].pct_early == 100.0 and got["R3"].route_mode == "other"
    assert got["R3"].is_night_route is None
    assert "R9U" not in got  # routes without observations do not appear


def test_positions_and_fleet(spark):
    stg = staging.stg_vehicle_positions(fx.positions(spark))
    ids = sorted(r.id for r in stg.collect())
    assert ids == [1, 2, 6, 7]  # FIL-1: any zero or null coordinate drops the row
    got = {r.id: r for r in stg.collect()}
    assert got[1].fetched_at_local == got[2].fetched_at_local == T("2024-10-27 02:30:00")
    assert (got[2].has_assigned_trip, got[1].has_assigned_trip) == (False, True)
    assert got[6].local_day_of_week == 6 and got[7].local_day_name == "Monday   "
    assert got[1].gps_reported_at == T("2024-06-01 08:00:00")
    fleet = {r.hour_bucket: r for r in marts.hourly_fleet(stg).collect()}
    merged = fleet[T("2024-10-27 02:00:00")]  # G-6: two UTC hours merge into one local hour
    assert (merged.position_reports, merged.active_vehicles, merged.vehicles_on_a_trip) == (2, 2, 1)
    assert fleet[T("2024-10-26 12:00:00")].active_routes == 1  # blank route counts (G-9)


def test_weather_latest_and_hourly(spark):
    stg = staging.stg_weather(fx.weather(spark))
    got = {r.observed_at: r for r in stg.collect()}
    assert len(got) == 4
    first = got[T("2024-06-01 10:00:00")]
    assert (first.temperature_c, first.weather_condition, first.is_precipitating) == (21.0, "rain", True)
    w = stg.transform(marts.hourly_weather).first()
    # conditions in the local hour: rain, cloudy, cloudy, rain -> tie -> smallest ('cloudy')
    assert w.dominant_condition == "cloudy"
    assert (w.avg_temperature_c, w.total_precipitation_mm, w.had_precipitation) == (22.1, 0.5, True)
    # the window form gives the same rows
    win = staging.stg_weather(fx.weather(spark), method="window")
    assert rows(win) == rows(stg)


def test_alert_staging_and_impact(spark):
    stg = staging.stg_alerts(fx.alerts(spark), as_of="2024-06-01 12:00:00")
    got = {(r.alert_id, r.route_id, r.stop_id, r.trip_id): r for r in stg.collect()}
    a1 = got[("A1", "R1U", None, None)]
    # G-12: per-column minimum mixes versions; the extended end is hidden.
    assert (a1.cause, a1.header_text, a1.times_observed) == ("STRIKE", "H", 5)
    assert a1.active_until == T("2024-06-02 00:00:00")
    assert a1.first_seen_at == T("2024-06-01 08:00:00") and a1.last_seen_at == T("2024-06-01 11:00:00")
    assert a1.observed_duration_seconds == 3 * 3600.0
    a2 = got[("A2", "R2E", None, None)]
    assert a2.active_until == T("1970-01-01 00:00:00") and a2.is_currently_active is False
    assert a2.planned_duration_seconds < 0 and a2.times_observed == 1
    assert a1.is_currently_active is True
    types = {k[0]: r.entity_type for k, r in got.items() if k[0] in ("A3", "A4", "A5")}
    assert types == {"A3": "unknown", "A4": "stop", "A5": "trip"}
    never = staging.stg_alerts(fx.alerts(spark), as_of="2024-06-01 12:00:00", open_end="never")
    assert [r.is_currently_active for r in never.collect() if r.alert_id == "A2"] == [True]

    impact = marts.fct_alert_impact(stg, staging.stg_routes(fx.routes(spark)))
    rows_ = {(r.route_id, r.alert_id): r for r in impact.collect()}
    assert set(rows_) == {("R1U", "A1"), ("R2E", "A2"), ("R1U", "A6"), ("R2E", "A6")}  # G-27
    assert rows_[("R1U", "A6")].stops_affected == rows_[("R2E", "A6")].stops_affected == 3  # G-21
    assert rows_[("R1U", "A1")].stops_affected == 0
    # G-20: local planned duration (no DST change here) equals the UTC one
    assert rows_[("R1U", "A1")].planned_duration_seconds == a1.planned_duration_seconds


def test_routes_and_stops(spark):
    r = {x.route_id: x for x in staging.stg_routes(fx.routes(spark)).collect()}
    assert (r["R1U"].route_mode, r["R1U"].route_color_hex, r["R2E"].route_color_hex) == ("tram", "FF0000", None)
    assert r["R9U"].route_mode == "funicular" and r["R9U"].route_text_color_hex == "000000"
    s = {x.stop_id: x for x in staging.stg_stops(fx.stops(spark)).collect()}
    assert set(s) == {"S1", "S4"}
    assert (s["S1"].latitude, s["S1"].is_wheelchair_accessible) == (45.07, True)
    assert (s["S4"].location_type, s["S4"].is_wheelchair_accessible) == ("1", None)
    assert s["S4"].stop_name == ""  # blank names are not null


def test_hourly_service_joins_from_fleet(spark):
    pos = staging.stg_vehicle_positions(fx.positions(spark))
    h = marts.fct_hourly_service(pos, stg_tu(spark), staging.stg_weather(fx.weather(spark)),
                                 sparse_threshold=2)
    out = h.collect()
    assert [r.hour_bucket for r in out] == sorted(r.hour_bucket for r in out)  # SRT-1
    assert all(r.delay_observations is None for r in out)  # G-22: no delay hours share fleet hours
    assert {r.is_sparse_hour for r in out} == {True, False}
    assert h.where(F.col("is_weekend")).count() == 2


def test_history_hot_key_split_matches_single_window(spark):
    from tramline.operators.windows import observation_history
    base = T("2024-06-01 00:00:00")
    data = [(1000 + i, "HOT", 2, (i * 7) % 50 - 20 if i % 9 else None,
             base + dt.timedelta(minutes=(i * 13) % 97)) for i in range(300)]
    data += [(5000 + i, f"K{i % 4}", 1, i, base + dt.timedelta(minutes=i)) for i in range(40)]
    data += [(9000, "HOT", 2, 5, None), (9001, "HOT", 2, 6, None)]  # null times sort last
    df = spark.createDataFrame(data, "id long, trip_id string, stop_sequence int, d int, "
                                     "fetched_at timestamp_ntz")
    args = (["trip_id", "stop_sequence"], ["fetched_at", "id"], "d")
    simple = observation_history(df, *args)
    split = observation_history(df, *args, split=True, ranges=8)
    assert rows(split) == rows(simple)
    hot = split.where("trip_id = 'HOT'")
    assert hot.agg(F.max("observation_number")).first()[0] == 302
    assert hot.where("fetched_at IS NULL").agg(F.min("recency_rank")).first()[0] == 1


def test_planned_duration_utc_vs_local_across_dst(spark):
    # G-20: 2024-10-26 12:00 UTC -> 2024-10-27 12:00 UTC is 24 h on UTC clocks but
    # 23 h between the local wall clocks (14:00 CEST -> 13:00 CET next day).
    from tramline import schemas
    start, end = 1729944000, 1730030400
    a = spark.createDataFrame([(1, "A1", "h", "C", "E", "S", "H", None, None, start, end, "R1U", None,
                                None, None, None, None, T("2024-10-26 12:00:00"))], schemas.RAW_ALERTS)
    stg = staging.stg_alerts(a, as_of="2024-10-27 00:00:00")
    r = stg.first()
    assert r.planned_duration_seconds == 24 * 3600.0
    assert (r.active_from_local, r.active_until_local) == (T("2024-10-26 14:00:00"), T("2024-10-27 13:00:00"))
    impact = marts.fct_alert_impact(stg, staging.stg_routes(fx.routes(spark))).first()
    assert impact.planned_duration_seconds == 23 * 3600.0
    assert impact.is_currently_active is True


def test_keep_latest_null_order_first_both_methods(spark):
    from tramline.operators.windows import keep_latest
    df = spark.createDataFrame([
        ("k1", 1, T("2024-06-01 10:00:00"), "old"),
        ("k1", 2, None, "null-time"),  # G-4: descending puts nulls first -> wins
        ("k2", 3, T("2024-06-01 10:00:00"), "a"),
        ("k2", 4, T("2024-06-01 10:00:00"), "b"),  # tie -> larger id
    ], "k string, id long, fetched_at timestamp_ntz, v string")
    for method in ("aggregate", "window"):
        got = dict(rows(keep_latest(df, ["k"], ["fetched_at", "id"], method=method), "k", "v"))
        assert got == {"k1": "null-time", "k2": "b"}, method


def test_route_performance_approx_option(spark):
    perf = marts.fct_route_performance(stg_tu(spark), staging.stg_routes(fx.routes(spark)),
                                       approx=True)
    got = {r.route_id: r for r in perf.collect()}
    assert got["R2E"].trips_observed == 2 and got["R2E"].median_delay_seconds in (61.0, 120.0)


def test_history_split_with_numeric_order(spark):
    from tramline.operators import windows
    data = [("HOT", i, (i * 37) % 101, i % 5) for i in range(120)] + [("K", i, i, 1) for i in range(5)]
    df = spark.createDataFrame(data, "k string, id long, seq long, d int")
    simple = windows.observation_history(df, ["k"], ["seq", "id"], "d")
    assert rows(windows.observation_history(df, ["k"], ["seq", "id"], "d", split=True, ranges=6)) == rows(simple)


def test_history_split_keeps_null_keys_text_order_and_equal_times(spark):
    from tramline.operators import windows
    data = [(None if i % 3 else "A", None if i % 2 else i % 4, f"t{i % 2}", f"id{i:04d}", i % 7 or None) for i in range(300)]
    data += [("H", 1, "same", f"id{i:04d}", i) for i in range(300)]
    df = spark.createDataFrame(data, "k string, s int, at string, id string, d int")
    simple = windows.observation_history(df, ["k", "s"], ["at", "id"], "d")
    split = windows.observation_history(df, ["k", "s"], ["at", "id"], "d", split=True, ranges=7)
    assert split.count() == 600 and rows(split) == rows(simple)
    hot = split.where("k = 'H'").groupBy().agg(F.max("observation_number"), F.min("recency_rank")).first()
    assert tuple(hot) == (300, 1)


def test_prediction_history_with_split_keys(spark):
    tu = staging.stg_trip_updates(fx.trip_updates(spark), fx.trips(spark), split_keys=True)
    assert rows(tu) == rows(stg_tu(spark))
