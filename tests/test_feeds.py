import datetime as dt

from pyspark.sql import functions as F

from tramline import schemas
from tramline.sources import feeds

T = dt.datetime.fromisoformat


def test_vehicle_flatten_defaults(spark):
    feed = spark.createDataFrame([(T("2024-06-01 08:00:00"), [
        ("e1", (("V1", "L1", None, None), ("T1", "R1", "08:00", "20240601"), (45.0, 7.6, 90.0), 100)),
        ("e2", None),  # no vehicle -> skipped
        ("e3", (("V3", None, None, None), None, None, None)),  # unset -> '' / 0
    ])], schemas.VEHICLE_FEED)
    out = sorted(feeds.flatten_vehicle_positions(feed).collect(), key=lambda r: r.id)
    assert len(out) == 2
    assert (out[0].vehicle_id, out[0].trip_id, out[0].latitude, out[0].gps_timestamp) == ("V1", "T1", 45.0, 100)
    assert (out[1].vehicle_label, out[1].trip_id, out[1].route_id, out[1].latitude, out[1].gps_timestamp) == ("", "", "", 0.0, 0)
    assert [r.id[18:] for r in out] == ["0" * 20, "0000000002" + "0" * 10]  # place in the snapshot
    assert out[0].id[:18] == out[1].id[:18]


def test_trip_flatten_delays(spark):
    stus = [(1, (10,), None), (2, None, (5,)), (3, (None,), (None,))]
    feed = spark.createDataFrame([(T("2024-06-01 08:00:00"), [
        ("e1", (("T1", None, None, None), ("V1", None, None, 2), 1717228800, stus)),
        ("e2", (("T2", None, None, None), ("V2", None, None, None), None, [])),  # no updates
        ("e3", None),
    ])], schemas.TRIP_FEED)
    out = sorted(feeds.flatten_trip_updates(feed).collect(), key=lambda r: r.stop_sequence)
    assert [(r.stop_sequence, r.arrival_delay_seconds, r.departure_delay_seconds) for r in out] == [
        (1, 10, None), (2, None, 5), (3, 0, 0)]
    assert {r.wheelchair_accessible for r in out} == {"2"}
    assert {r.route_id for r in out} == {""}
    assert len({r.id for r in out}) == 3


def test_alert_flatten(spark):
    tr = lambda *p: (list(p),)
    feed = spark.createDataFrame([(T("2024-06-01 08:00:00"), [
        ("A1", (None, 4, None, tr(("Hello", "en"), ("Ciao", "it")), None, tr(),
                [(100, 200), (300, 400)],
                [("R1", None, None), (None, "S1", None), ("", "", ("T9",))])),
        ("A2", (6, None, 3, tr(("Only", "en")), tr(("Desc", "it")), None, [], [])),
        ("A3", None),
    ])], schemas.ALERT_FEED)
    out = feeds.flatten_alerts(feed).collect()
    a1 = sorted([r for r in out if r.alert_id == "A1"], key=lambda r: r.id)
    a2 = [r for r in out if r.alert_id == "A2"]
    assert len(a1) == 3 and len(a2) == 1 and len(out) == 4
    assert (a1[0].cause, a1[0].effect, a1[0].severity_level) == ("UNKNOWN_CAUSE", "DETOUR", "UNKNOWN_SEVERITY")
    assert (a1[0].header_text, a1[0].url) == ("Ciao", None)
    assert (a1[0].active_period_start, a1[0].active_period_end) == (100, 200)  # G-11
    assert [(r.informed_route_id, r.informed_stop_id, r.informed_trip_id) for r in a1] == [
        ("R1", None, None), (None, "S1", None), (None, None, "T9")]
    assert len({r.content_hash for r in a1}) == 1
    b = a2[0]
    assert (b.header_text, b.description_text, b.active_period_start) == ("Only", "Desc", None)
    assert (b.informed_route_id, b.times_seen, b.first_seen_at) == (None, 1, T("2024-06-01 08:00:00"))
    assert b.effect == "UNKNOWN_EFFECT"


def test_weather_json(spark, tmp_path):
    p = tmp_path / "w.json"
    p.write_text('{"fetched_at": "2024-06-01T08:03:00.000000", "current": {"time": "2024-06-01T08:00", '
                 '"temperature_2m": 21.5, "precipitation": 0.2, "wind_speed_10m": 3.0, "weather_code": 61}}\n')
    r = feeds.flatten_weather(feeds.read_weather_json(spark, str(p))).first()
    assert (r.observed_at, r.temperature_c, r.weather_code) == (T("2024-06-01 08:00:00"), 21.5, 61)
    assert r.fetched_at == T("2024-06-01 08:03:00")


def test_row_ids_never_collide_or_overflow(spark):
    times = [T("2024-06-01 08:00:00"), T("2024-06-01 08:00:00.000001"), T("2199-12-31 23:59:59"), T("1950-01-01 00:00:00")]
    df = spark.createDataFrame([(t, e, s) for t in times for e in (0, 1, 2**31 - 1) for s in (0, 4999, 5000, 2**31 - 1)],
                               "t timestamp_ntz, e long, s long")
    got = df.select("t", "e", "s", feeds.snapshot_row_id("t", F.col("e"), F.col("s")).alias("id")).collect()
    assert len({r.id for r in got}) == len(got) and {len(r.id) for r in got} == {38}
    assert sorted(got, key=lambda r: r.id) == sorted(got, key=lambda r: (r.t, r.e, r.s))


def test_line_ids_at_any_size(spark):
    from tramline.sources.testdata import line_id
    df = spark.createDataFrame([(o, 1, p, 10**6, 50.0) for o in (1, 10**10, 10**18) for p in (5, 10**7)],
                               "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double")
    assert df.select(line_id().alias("id")).distinct().count() == 6
