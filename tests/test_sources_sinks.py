import datetime as dt

from pyspark.sql import functions as F

import fixtures as fx
from conftest import rows
from tramline.operators import sinks, upsert
from tramline.session import scratch_dir
from tramline.sources import gtfs

T = dt.datetime.fromisoformat


def test_small_csv_edge_cases(spark, tmp_path):
    root = tmp_path / "feed"
    root.mkdir()
    raw = ('﻿stop_id,stop_name,stop_lat,stop_lon\n'
           '1,"Piazza, Castello",45.07,7.68\n'
           '2,"Line one\nline two",45.08,7.69\n'
           '3,"Say ""hi""",,7.70\n'
           '4,Short\n'
           '5,Long,45.1,7.7,surplus\n'
           '\n').encode("utf-8") + b'6,Bad\xff,45.2,7.8\n'
    (root / "stops.txt").write_bytes(raw)
    (root / "agency.txt").write_text("")  # no header -> skipped
    (root / "calendar.txt").write_text("service_id,monday\n")  # header only -> empty table
    tables, skipped = gtfs.load_feed(spark, str(root), loaded_at="2024-06-01 00:00:00")
    assert "agency.txt" in skipped and "routes.txt" in skipped and "stop_times.txt" in skipped
    assert tables["gtfs_calendar"].count() == 0
    s = {r.stop_id: r for r in tables["gtfs_stops"].collect()}
    assert tables["gtfs_stops"].columns[0] == "stop_id"  # byte-order mark stripped
    assert set(s) == {"1", "2", "3", "4", "5", "6"}  # blank line skipped
    assert s["1"].stop_name == "Piazza, Castello"
    assert s["2"].stop_name == "Line one\nline two"
    assert (s["3"].stop_name, s["3"].stop_lat) == ('Say "hi"', "")
    assert (s["4"].stop_name, s["4"].stop_lat, s["4"].stop_lon) == ("Short", None, None)  # missing fields
    assert s["5"].stop_lon == "7.7"  # surplus field dropped
    assert "�" in s["6"].stop_name  # bad byte replaced
    assert s["1"].loaded_at == T("2024-06-01 00:00:00")


def test_bulk_csv_blank_vs_null(spark, tmp_path):
    root = tmp_path / "feed"
    root.mkdir()
    (root / "stop_times.txt").write_text(
        'trip_id,arrival_time,stop_id\nT1,,S1\nT1,"",S2\nT2,08:00:00,"a,b"\n')
    tables, _ = gtfs.load_feed(spark, str(root))
    got = rows(tables["gtfs_stop_times"], "trip_id", "arrival_time", "stop_id")
    assert got == [("T1", "", "S2"), ("T1", None, "S1"), ("T2", "08:00:00", "a,b")]


def test_fold_is_order_free(spark):
    a = fx.alerts(spark)
    first, second = a.where(F.col("id") <= 5), a.where(F.col("id") > 5)
    both = upsert.fold_alerts(None, a)
    stepwise = upsert.fold_alerts(upsert.fold_alerts(None, first), second)
    reverse = upsert.fold_alerts(upsert.fold_alerts(None, second), first)
    assert rows(both) == rows(stepwise) == rows(reverse)


def test_fold_counts_rows_and_keeps_first(spark):
    a = fx.alerts(spark).where(F.col("id") == 3)
    later = a.withColumn("id", F.lit(30)).withColumn("fetched_at", F.lit(T("2024-06-01 09:00:00")))
    dup = later.withColumn("id", F.lit(31))  # G-14: repeated in one snapshot -> counts twice
    state = upsert.fold_alerts(upsert.fold_alerts(None, a), later.unionByName(dup)).first()
    assert (state.id, state.times_seen) == (3, 3)
    assert (state.first_seen_at, state.last_seen_at) == (T("2024-06-01 08:00:00"), T("2024-06-01 09:00:00"))
    assert state.fetched_at == T("2024-06-01 08:00:00")
    out = upsert.upsert_outcome(a, later.unionByName(dup)).first()
    assert (out.inserted, out.refreshed) == (0, 2)
    out = upsert.upsert_outcome(a.where("false"), later.unionByName(dup)).first()
    assert (out.inserted, out.refreshed) == (1, 1)


def test_alerts_without_a_fingerprint_stay_apart(spark):
    a = fx.alerts(spark).withColumn("content_hash", F.lit(None).cast("string")).withColumn("alert_id", F.lit("same"))
    two = a.where(F.col("id").isin(1, 3)).withColumn("header_text", F.concat(F.lit("h"), F.col("id").cast("string")))
    folded = upsert.fold_alerts(None, two)
    assert folded.count() == 2 and folded.where(F.col("content_hash").isNull()).count() == 0
    out = upsert.upsert_outcome(two.where("id = 1"), two).first()
    assert (out.inserted, out.refreshed) == (1, 1)
    assert rows(upsert.backfill(two)) == rows(upsert.collapse_duplicates(upsert.backfill_hashes(two)))


def test_collapse_survivor_anti_join(spark):
    a = fx.alerts(spark)
    dup = a.where(F.col("id").isin(1, 3)).withColumn("id", F.col("id") + 100).withColumn(
        "fetched_at", F.lit(T("2024-06-02 00:00:00")))
    raw = a.unionByName(dup)
    c = {r.id: r for r in upsert.collapse_duplicates(raw).collect()}
    assert set(c) == set(range(1, 12))
    assert (c[1].times_seen, c[1].last_seen_at) == (2, T("2024-06-02 00:00:00"))  # G-18
    assert c[2].times_seen == 1
    assert sorted(r.id for r in upsert.duplicate_rows(raw).collect()) == [101, 103]
    s = {r.id: r for r in upsert.survivor_update(raw).collect()}
    assert len(s) == 13 and s[1].times_seen == 2 and s[101].times_seen == 3
    # annotate survivors, then delete the rest == the one-pass collapse
    two_step = upsert.survivor_update(raw).join(upsert.duplicate_rows(raw).select("id"), "id",
                                                "left_anti")
    assert rows(two_step) == rows(upsert.collapse_duplicates(raw))


def test_backfill_hash_restores(spark):
    a = fx.alerts(spark)
    orig = upsert.backfill_hashes(a.withColumn("content_hash", F.lit(None).cast("string")))
    again = upsert.backfill_hashes(orig.withColumn(
        "content_hash", F.when(F.col("id") % 2 == 0, F.col("content_hash"))))
    assert rows(orig, "id", "content_hash") == rows(again, "id", "content_hash")


def test_append_evolve_refresh_counts(spark):
    path = scratch_dir(spark, "append-test")
    pos = fx.positions(spark)
    sinks.append_snapshot(pos.where(F.col("id") <= 3), path)
    sinks.append_snapshot(pos.where(F.col("id") > 3), path)
    back = sinks.read_landed(spark, path)
    assert back.count() == 7 and "fetch_date" in back.columns
    old = fx.alerts(spark).drop("content_hash", "times_seen")
    merged = sinks.union_evolving(old, fx.alerts(spark), {"times_seen": 1})
    assert merged.where(F.col("times_seen").isNull()).count() == 0
    ref = scratch_dir(spark, "refresh-test")
    sinks.full_refresh(fx.stops(spark).drop("loaded_at"), ref, "2024-01-01 00:00:00", 1)
    sinks.full_refresh(fx.stops(spark).drop("loaded_at").limit(2), ref, "2024-02-01 00:00:00", 2)
    # a load that was never published, and one that is retried
    fx.stops(spark).write.parquet(f"{ref}/version=9")
    sinks.full_refresh(fx.stops(spark).drop("loaded_at").limit(2), ref, "2024-02-01 00:00:00", 2)
    cur = sinks.read_current(spark, ref)
    assert cur.count() == 2 and {r.loaded_at for r in cur.collect()} == {T("2024-02-01 00:00:00")}
    counts = dict(rows(sinks.row_counts({"a": pos, "b": fx.stops(spark)})))
    assert counts == {"a": 7, "b": 4}


def test_only_a_missing_path_is_absent(spark, tmp_path):
    import pytest

    assert sinks.read_if_present(spark, str(tmp_path / "none")) is None
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "x.parquet").write_text("not parquet")
    with pytest.raises(Exception, match="(?i)parquet|footer|magic"):
        sinks.read_if_present(spark, str(tmp_path / "bad")).count()


def test_timetable_refresh_job(spark, tmp_path):
    root, store = tmp_path / "feed", str(tmp_path / "store")
    root.mkdir()
    (root / "stops.txt").write_text("stop_id,stop_name\n1,A\n2\n")
    assert "routes.txt" in gtfs.refresh_feed(spark, str(root), store, "2024-06-01 00:00:00")
    (root / "stops.txt").write_text("stop_id,stop_name\n3,C\n")
    gtfs.refresh_feed(spark, str(root), store, "2024-06-02 00:00:00")
    stored = gtfs.stored_feed(spark, store)
    assert list(stored) == ["gtfs_stops"]
    assert rows(stored["gtfs_stops"], "stop_id", "stop_name") == [("3", "C")]


def test_landed_columns_come_from_the_record(spark):
    path = scratch_dir(spark, "record-test")
    old = fx.alerts(spark).drop("content_hash", "times_seen")
    sinks.append_snapshot(old, path)
    sinks.append_snapshot(old, path)
    sinks.append_snapshot(fx.alerts(spark), path)
    sinks.append_snapshot(old, path)
    assert spark.read.parquet(f"{path}/_schema").count() == 2  # a row per change
    back = sinks.read_landed(spark, path)
    assert set(back.columns) == {*fx.alerts(spark).columns, "fetch_date"}
    n = old.count()
    assert back.count() == 4 * n and back.where("times_seen IS NULL").count() >= 3 * n
    plain = scratch_dir(spark, "record-none")
    old.withColumn("fetch_date", F.to_date("fetched_at")).write.partitionBy("fetch_date").parquet(plain)
    fx.alerts(spark).withColumn("fetch_date", F.to_date("fetched_at")).write.mode("append").partitionBy("fetch_date").parquet(plain)
    assert "times_seen" in sinks.read_landed(spark, plain).columns
