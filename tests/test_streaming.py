import datetime as dt

import pytest
from pyspark.sql import functions as F

import fixtures as fx
from conftest import rows
from tramline import schemas
from tramline.functions.time import hour_bucket
from tramline.operators import sinks, upsert
from tramline.operators.windows import keep_latest
from tramline.session import scratch_dir
from tramline.streaming import jobs


def deliver(spark, name, chunks, start, schema):
    """Land the chunks one by one, restarting the stream after each."""
    root = scratch_dir(spark, name)
    for i, c in enumerate(chunks):
        c.write.mode("overwrite").parquet(f"{root}/src/d{i}")
        start(jobs.file_stream(spark, f"{root}/src/*", schema), root)
    return root


def split_at(df, text):
    cut = F.lit(text).cast("timestamp_ntz")
    return df.where(F.col("fetched_at") < cut), df.where(F.col("fetched_at") >= cut)


@pytest.mark.parametrize("compact_every", [None, 1])
def test_alert_folds_equal_batch_fold_in_any_order(spark, compact_every):
    a = fx.alerts(spark)
    chunks = [a.where(F.col("id") > 4), a.where(F.col("id") <= 4), a.where(F.col("id") == 2)]
    root = deliver(spark, "t-fold", chunks,
                   lambda s, r: jobs.fold_batches(s, jobs.alert_folds(spark, f"{r}/state"), f"{r}/ckpt",
                                                  compact_every=compact_every), schemas.RAW_ALERTS)
    want = upsert.fold_alerts(None, chunks[0].unionByName(chunks[1]).unionByName(chunks[2]))
    assert rows(jobs.alert_folds(spark, f"{root}/state").read()) == rows(want)


def test_replayed_and_late_rows_land_once(spark):
    early, late = split_at(fx.positions(spark), "2024-10-27 01:00:00")
    for order in ([early, late, early], [late, early, late, early], [late, late.unionByName(late), early]):
        root = deliver(spark, "t-replay", order, lambda s, r: jobs.append_new_rows(s, f"{r}/sink", f"{r}/ckpt"),
                       schemas.RAW_VEHICLE_POSITIONS)
        assert sorted(r.id for r in jobs.read_rows(spark, f"{root}/sink").collect()) == [1, 2, 3, 4, 5, 6, 7]


def test_rows_without_a_time_land_once(spark):
    pos = fx.positions(spark).withColumn("fetched_at", F.lit(None).cast("timestamp_ntz"))
    root = deliver(spark, "t-null", [pos, pos], lambda s, r: jobs.append_new_rows(s, f"{r}/sink", f"{r}/ckpt"),
                   schemas.RAW_VEHICLE_POSITIONS)
    assert sorted(r.id for r in jobs.read_rows(spark, f"{root}/sink").collect()) == [1, 2, 3, 4, 5, 6, 7]


def test_late_fleet_reports_and_weather_count(spark):
    pos = fx.positions(spark)
    early, late = split_at(pos, "2024-10-27 01:00:00")
    root = deliver(spark, "t-fleet", [late, early],
                   lambda s, r: jobs.fold_batches(s, jobs.hourly_fleet(spark, f"{r}/state"), f"{r}/ckpt"),
                   schemas.RAW_VEHICLE_POSITIONS)
    got = rows(jobs.read_hourly_fleet(jobs.hourly_fleet(spark, f"{root}/state")))
    valid = pos.where((F.col("latitude") != 0) & (F.col("longitude") != 0))
    assert got == rows(valid.groupBy(hour_bucket("fetched_at").alias("hour_utc")).agg(
        F.count_distinct("vehicle_id"), F.count(F.lit(1))))
    assert [(r[1], r[2]) for r in got] == [(1, 1), (1, 1), (1, 1), (1, 1)]  # UTC hours stay apart
    wx = fx.weather(spark)
    for chunks in ([wx.where(F.col("id") != 2), wx.where(F.col("id") == 2)], [wx.where(F.col("id") == 2), wx.where(F.col("id") != 2)]):
        root = deliver(spark, "t-wx", chunks,
                       lambda s, r: jobs.fold_batches(s, jobs.latest_weather(spark, f"{r}/state"), f"{r}/ckpt"),
                       schemas.RAW_WEATHER)
        assert rows(jobs.latest_weather(spark, f"{root}/state").read().select(*wx.columns)) == rows(
            keep_latest(wx, ["observed_at"], ["fetched_at", "id"]))


def reports(spark, *rows_):
    return spark.createDataFrame([(i, v, 45.0, 7.6, dt.datetime.fromisoformat(t)) for i, (v, t) in enumerate(rows_)],
                                 "id long, vehicle_id string, latitude double, longitude double, fetched_at timestamp_ntz")


def test_hours_behind_the_watermark_are_final_and_late_reports_counted(spark):
    first = reports(spark, ("a", "2024-06-01 08:10:00"), ("b", "2024-06-01 08:20:00"), ("a", "2024-06-01 09:30:00"),
                    ("a", "2024-06-01 11:05:00"))
    second = reports(spark, ("c", "2024-06-01 08:50:00"), ("a", "2024-06-01 08:55:00"),  # late: their hour is final
                     ("a", "2024-06-01 07:00:00"),  # an hour that nobody reported in time
                     ("b", "2024-06-01 10:30:00"))  # behind the newest, but its hour is open

    def start(s, r):
        again = jobs.file_stream(spark, f"{r}/src/*", first.schema)
        jobs.fold_batches(s, jobs.hourly_fleet(spark, f"{r}/state"), f"{r}/ckpt")
        jobs.close_hours(again, jobs.hour_closings(spark, f"{r}/final"), f"{r}/ckpt-final", delay="1 hour", state_partitions=3)
    root = deliver(spark, "t-final", [first], start, first.schema)
    log, closings = jobs.hourly_fleet(spark, f"{root}/state"), jobs.hour_closings(spark, f"{root}/final")
    hour = lambda h: dt.datetime(2024, 6, 1, h)
    got = {r.hour_utc: tuple(r)[1:] for r in jobs.read_hourly_fleet(log, closings).collect()}
    # The watermark is 10:05: hours 8 and 9 are over, hour 11 isn't.
    assert got == {hour(8): (2, 2, True, 0), hour(9): (1, 1, True, 0), hour(11): (1, 1, False, 0)}
    second.write.mode("overwrite").parquet(f"{root}/src/d1")
    start(jobs.file_stream(spark, f"{root}/src/*", first.schema), root)
    got = {r.hour_utc: tuple(r)[1:] for r in jobs.read_hourly_fleet(log, closings).collect()}
    assert got == {hour(7): (1, 1, True, 1), hour(8): (3, 4, True, 2), hour(9): (1, 1, True, 0), hour(10): (1, 1, False, 0),
                   hour(11): (1, 1, False, 0)}
    # A new checkpoint closes its hours again and changes nothing but what it saw in time.
    jobs.close_hours(jobs.file_stream(spark, f"{root}/src/*", first.schema), closings, f"{root}/ckpt-new", delay="1 hour")
    assert {r.hour_utc: r.position_reports for r in jobs.read_hourly_fleet(log, closings).collect()} == {k: v[1] for k, v in got.items()}


def test_nothing_is_final_before_the_first_closing(spark):
    root = scratch_dir(spark, "t-open")
    jobs.hourly_fleet(spark, root).append(reports(spark, ("a", "2024-06-01 08:10:00")), 0, "x")
    row = jobs.read_hourly_fleet(jobs.hourly_fleet(spark, root), jobs.hour_closings(spark, f"{root}-none")).first()
    assert (row.is_final, row.late_reports) == (False, 0)


def test_sketched_vehicles_merge_within_the_error(spark):
    root = scratch_dir(spark, "t-sketch")
    exact, approx = jobs.hourly_fleet(spark, f"{root}/exact"), jobs.sketched_fleet(spark, f"{root}/approx")
    rows_ = spark.range(30_000).select(
        "id", (F.col("id") % 9_000).cast("string").alias("vehicle_id"), F.lit(45.0).alias("latitude"), F.lit(7.6).alias("longitude"),
        (F.lit("2024-06-01 08:00:00").cast("timestamp_ntz") + F.make_dt_interval(hours=(F.col("id") % 2).cast("int"))).alias("fetched_at"))
    for n in range(3):
        for log in (exact, approx):
            log.append(rows_.where(F.col("id") % 3 == n), n, "x")
    approx.compact()
    want = {r.hour_utc: (r.active_vehicles, r.position_reports) for r in jobs.read_hourly_fleet(exact).collect()}
    got = {r.hour_utc: (r.active_vehicles, r.position_reports) for r in jobs.read_sketched_fleet(approx).collect()}
    assert set(got) == set(want) and approx.partials().count() == 2  # a row per hour, whatever the vehicles
    for h, (vehicles, n) in want.items():
        assert got[h][1] == n and abs(got[h][0] - vehicles) <= 4 * 0.0163 * vehicles


def test_enrichment_follows_published_versions_and_deals_no_trip_table(spark):
    root = scratch_dir(spark, "t-versions")
    updates = fx.trip_updates(spark)
    trips = fx.trips(spark)
    table = jobs.PublishedTable(spark, f"{root}/trips")
    with pytest.raises(FileNotFoundError):
        table.current()
    plans = []

    def deliver_with(version, versioned, name):
        sinks.publish_keyed(versioned, f"{root}/trips", "trip_id", version, buckets=4)
        updates.write.mode("overwrite").parquet(f"{root}/{name}/d0")
        jobs.enrich_batches(jobs.file_stream(spark, f"{root}/{name}/*", updates.schema), table, f"{root}/sink", f"{root}/ckpt-{name}")
        plans.append(jobs.enrich_stream(updates, table.current())._jdf.queryExecution().executedPlan().toString())
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold"), spark.conf.get("spark.sql.adaptive.autoBroadcastJoinThreshold", None)
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
        deliver_with(1, trips.withColumn("route_id", F.lit("OLD")), "one")
        first = table.table
        assert table.current() is first  # kept until another version is published
        deliver_with(2, trips.withColumn("route_id", F.lit("NEW")), "two")
        assert table.version == 2 and table.table is not first
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old[0])
        if old[1] is None:
            spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
        else:
            spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", old[1])
    got = {(r.route_id, r["count"]) for r in spark.read.parquet(f"{root}/sink").where("route_id IS NOT NULL").groupBy("route_id").count().collect()}
    n = updates.join(trips, "trip_id").count()
    assert got == {("OLD", n), ("NEW", n)}
    assert all(p.count("Exchange hashpartitioning") == 1 for p in plans), plans[0]  # the micro-batch's alone
