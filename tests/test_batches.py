"""Batch identity, landed keys, incremental history and the command line end to end."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

import fixtures as fx
from conftest import rows
from tramline import schemas
from tramline.__main__ import _flatten, _fold, _refresh, _run, parse
from tramline.operators import landing, sinks, storage
from tramline.operators.foldlog import FoldLog
from tramline.operators.windows import observation_history
from tramline.plans import staging
from tramline.plans.catalog import read_model, read_source
from tramline.session import scratch_dir
from tramline.streaming import jobs

T = dt.datetime.fromisoformat


def counts(spark, path):
    return FoldLog(spark, path, lambda rows: rows.groupBy("k").agg(F.sum("n").alias("n")))


def batch(spark, *keys):
    return spark.createDataFrame([(k, 1) for k in keys], "k string, n long")


def state(log):
    return dict(rows(log.read()))


def test_retries_count_once_and_equal_numbers_of_two_sources_stay_apart(spark):
    log = counts(spark, scratch_dir(spark, "t-log"))
    log.append(batch(spark, "a"), 1, "x")
    log.append(batch(spark, "b"), 2, "x")
    log.append(batch(spark, "c"), 2, "y")  # another query, or a new checkpoint, with the same number
    log.append(batch(spark, "b"), 2, "x")  # a true retry
    assert state(log) == {"a": 1, "b": 1, "c": 1}
    log.compact()
    assert state(log) == {"a": 1, "b": 1, "c": 1} and log.batches() == []
    assert not log.append(batch(spark, "b"), 2, "x")  # a retry of what the base holds
    assert log.append(batch(spark, "a"), 1, "y2") and log.append(batch(spark, "a"), 3, "x")
    assert state(log) == {"a": 3, "b": 1, "c": 1}
    log.compact()
    log.compact()
    assert state(counts(spark, log.path)) == {"a": 3, "b": 1, "c": 1}


def test_what_a_base_holds_is_expired(spark):
    log = counts(spark, scratch_dir(spark, "t-expire"))
    for n in range(3):
        log.append(batch(spark, "a"), n, "x")
        log.compact()
    log.append(batch(spark, "b"), 3, "x")
    log.expire(3600)  # too young
    assert len(storage.folders(spark, f"{log.path}/base")) == 3
    log.expire(0)
    assert [f.name for f in storage.folders(spark, f"{log.path}/log/source=x")] == ["batch_id=3"]
    assert len(storage.folders(spark, f"{log.path}/base")) == len(storage.folders(spark, f"{log.path}/published")) == 1
    assert state(log) == {"a": 3, "b": 1}
    assert not log.append(batch(spark, "a"), 1, "x")  # still known


def test_an_unfinished_batch_is_not_read(spark):
    log = counts(spark, scratch_dir(spark, "t-torn"))
    log.append(batch(spark, "a"), 0, "x")
    batch(spark, "b").write.parquet(f"{log.path}/log/source=x/batch_id=1")
    storage.delete(spark, f"{log.path}/log/source=x/batch_id=1/_SUCCESS")
    assert state(log) == {"a": 1}
    with pytest.raises(FileNotFoundError):
        counts(spark, scratch_dir(spark, "t-none")).read()


def deliver(spark, root, name, df, checkpoint, start):
    df.write.mode("overwrite").parquet(f"{root}/{name}/d0")
    start(jobs.file_stream(spark, f"{root}/{name}/*", df.schema), checkpoint)


def test_two_checkpoints_on_one_folder_lose_and_double_nothing(spark):
    root = scratch_dir(spark, "t-two")
    pos = fx.positions(spark)

    def land(s, c):
        jobs.append_new_rows(s, f"{root}/sink", c)
    deliver(spark, root, "one", pos.where("id <= 4"), f"{root}/c1", land)
    deliver(spark, root, "two", pos.where("id >= 3"), f"{root}/c2", land)  # a fresh checkpoint: batch 0 again
    assert sorted(r.id for r in jobs.read_rows(spark, f"{root}/sink").collect()) == [1, 2, 3, 4, 5, 6, 7]
    a = fx.alerts(spark)

    def fold(s, c):
        jobs.fold_batches(s, jobs.alert_folds(spark, f"{root}/state"), c, compact_every=2)
    deliver(spark, root, "three", a.where("id <= 5"), f"{root}/c3", fold)
    deliver(spark, root, "four", a.where("id > 5"), f"{root}/c4", fold)
    from tramline.operators import upsert
    assert rows(jobs.alert_folds(spark, f"{root}/state").read()) == rows(upsert.fold_alerts(None, a))


def test_landing_work_does_not_grow_with_the_number_of_batches(spark):
    sink = scratch_dir(spark, "t-keys")
    when = F.lit("2024-06-01 08:00:00").cast("timestamp_ntz")
    most = 0
    for n in range(13):
        own = spark.range(n * 5, n * 5 + 8).select(F.col("id"), when.alias("fetched_at"))  # three ids come again
        landing.land_new_rows(own, sink, "q", n, merge_entries=3)
        if n % 6 == 0:
            landing.land_new_rows(own, sink, "q", n, merge_entries=3)  # a retry
        entries = storage.folders(spark, f"{sink}/keys/fetch_date=2024-06-01/source=q")
        most = max(most, len(entries))
    assert most <= 2 * 3 + 3
    landed = [r.id for r in landing.read_rows(spark, sink).collect()]
    assert sorted(landed) == list(range(68))
    assert landing.known_keys(spark, sink, [dt.date(2024, 6, 1)]).distinct().count() == 68
    assert landing.known_keys(spark, sink, [dt.date(2030, 1, 1)]) is None


def test_a_batch_of_many_dates_writes_each_date_once(spark):
    sink = scratch_dir(spark, "t-dates")
    day = F.expr("timestamp_ntz'2024-01-01 08:00:00' + make_dt_interval(cast(id % 60 AS INT))")
    # the 60th day's rows have no time
    pos = spark.range(0, 2400, 1, 8).select("id", F.when(F.col("id") % 60 < 59, day).alias("fetched_at"))
    for n in range(6):
        landing.land_new_rows(pos.where(f"id < {400 * (n + 1)}"), sink, "q", n, merge_entries=2)
        if n in (2, 3):
            landing.land_new_rows(pos.where(f"id < {400 * (n + 1)}"), sink, "q", n, merge_entries=2)  # a retry
    assert sorted(r.id for r in landing.read_rows(spark, sink).collect()) == list(range(2400))
    files = spark.read.parquet(f"{sink}/rows").select("fetch_date", "batch_id", F.input_file_name().alias("f")).distinct()
    assert files.groupBy("fetch_date", "batch_id").count().agg(F.max("count")).first()[0] == 1
    dates = [None] + [dt.date(2024, 1, 1) + dt.timedelta(days=n) for n in range(59)]
    assert landing.known_keys(spark, sink, dates).distinct().count() == 2400
    for d in ("2024-01-01", "2024-02-28", "__HIVE_DEFAULT_PARTITION__"):
        names = [f.name for f in storage.folders(spark, f"{sink}/keys/fetch_date={d}/source=q")]
        assert any(x.endswith("-merged") for x in names) and "entry=000000000000-batch" not in names


def test_a_retry_after_a_failure_replaces_its_own_rows(spark):
    sink = scratch_dir(spark, "t-torn-rows")
    pos = fx.positions(spark)
    landing.land_new_rows(pos.where("id < 3"), sink, "q", 0)
    # An attempt that wrote its rows but not its keys.
    landing.land_new_rows(pos.where("id >= 3"), sink, "q", 1)
    for f in storage.folders(spark, f"{sink}/keys"):
        storage.delete(spark, f"{sink}/keys/{f.name}/source=q/entry=000000000001-batch")
    landing.land_new_rows(pos.where("id >= 3"), sink, "q", 1)
    assert sorted(r.id for r in landing.read_rows(spark, sink).collect()) == [1, 2, 3, 4, 5, 6, 7]
    landing.land_new_rows(pos.limit(0), sink, "q", 2)
    assert landing.read_rows(spark, sink).count() == 7


@pytest.mark.parametrize("split", [False, True])
def test_history_by_slices_equals_the_whole(spark, split):
    path = scratch_dir(spark, "t-history")
    times = ["2024-06-01 08:00:00", "2024-06-01 09:00:00", "2024-06-02 08:00:00", "2024-06-03 07:00:00", None]
    raw = spark.createDataFrame(
        [(i, f"T{i % 3}" if i % 7 else None, i % 2, T(t) if t else None, None if i % 5 == 0 else i * 10)
         for i, t in enumerate(times * 6)], "id int, trip_id string, stop_sequence int, fetched_at timestamp_ntz, delay int")
    raw.withColumn("fetch_date", F.to_date("fetched_at")).write.partitionBy("fetch_date").parquet(f"{path}-raw")
    landed = spark.read.parquet(f"{path}-raw")
    from tramline.operators.history import HistorySlices
    keys, order = ["trip_id", "stop_sequence"], ["fetched_at", "id"]
    slices = HistorySlices(spark, path, keys, order, "delay", split=split)
    cols = ["id", *keys, "observation_number", "total_observations", "previous_value", "first_value", "recency_rank"]

    def same(part):
        want = observation_history(part, keys, order, "delay")
        assert rows(slices.read().select(*cols)) == rows(want.select(*cols))
    day = [dt.date(2024, 6, d) for d in (1, 2, 3)]
    slices.update(landed, [day[0], day[2]])
    same(raw.where("to_date(fetched_at) IN (DATE'2024-06-01', DATE'2024-06-03')"))
    slices.update(landed, [day[1]])  # a late date
    slices.update(landed, [day[0]])  # a date made anew
    same(raw.where("fetched_at IS NOT NULL"))
    slices.update(landed, [None])
    same(raw)
    some = slices.read([day[1]]).select(*cols)
    whole = observation_history(raw, keys, order, "delay").where("to_date(fetched_at) = DATE'2024-06-02'")
    assert rows(some) == rows(whole.select(*cols))


def test_only_new_dates_are_read(spark):
    path = scratch_dir(spark, "t-pruned")
    raw = fx.trip_updates(spark).withColumn("fetch_date", F.to_date("fetched_at"))
    raw.write.partitionBy("fetch_date").parquet(f"{path}-raw")
    dates = sorted(r[0] for r in raw.select("fetch_date").distinct().collect() if r[0])
    history = staging.trip_history(spark, path)
    history.update(staging.trip_observations(spark.read.parquet(f"{path}-raw")), dates)
    # The raw rows of these dates are gone; the next dates need none of them.
    for d in dates:
        storage.delete(spark, f"{path}-raw/fetch_date={d}")
    later = fx.trip_updates(spark).withColumns({
        "fetched_at": F.col("fetched_at") + F.expr("INTERVAL 400 DAYS"), "id": F.col("id") + 1000})
    later.withColumn("fetch_date", F.to_date("fetched_at")).write.mode("append").partitionBy("fetch_date").parquet(f"{path}-raw")
    new = sorted(r[0] for r in later.select(F.to_date("fetched_at")).distinct().collect() if r[0])
    history.update(staging.trip_observations(spark.read.parquet(f"{path}-raw")), new)
    both = fx.trip_updates(spark).unionByName(later)
    want = staging.stg_trip_updates(both, fx.trips(spark))
    got = staging.stg_trip_updates_from(history, fx.trips(spark))
    assert got.columns == want.columns and rows(got) == rows(want)


def test_stored_rows_are_dealt_once(spark):
    """Rows and records of all slices share one exchange, which the join with the trips uses too."""
    path = scratch_dir(spark, "t-dealt")
    raw = fx.trip_updates(spark).withColumn("fetch_date", F.to_date("fetched_at"))
    dates = [r[0] for r in raw.select("fetch_date").distinct().collect()]
    history = staging.trip_history(spark, path)
    key = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(key)
    try:
        spark.conf.set(key, "-1")  # as for tables beyond the bound
        history.update(staging.trip_observations(raw), dates)
        got = staging.stg_trip_updates_from(history, fx.trips(spark))
        text = got._jdf.queryExecution().executedPlan().toString()
        assert text.count("Exchange hashpartitioning") == 2  # one of them of the trips
        assert rows(got) == rows(staging.stg_trip_updates(fx.trip_updates(spark), fx.trips(spark)))
    finally:
        spark.conf.set(key, old)


@pytest.fixture
def feed(spark, tmp_path):
    from tramline.sources import gtfs
    gtfs.write_csv(fx.routes(spark).drop("loaded_at"), str(tmp_path / "gtfs" / "routes.txt"))
    gtfs.write_csv(fx.stops(spark).drop("loaded_at"), str(tmp_path / "gtfs" / "stops.txt"))
    gtfs.write_csv(fx.trips(spark), str(tmp_path / "gtfs" / "trips.txt"))
    return str(tmp_path / "gtfs")


def test_command_line_from_feeds_to_marts(spark, tmp_path, feed, capsys):
    raw, out = tmp_path / "raw", str(tmp_path / "out")
    snapshot = spark.createDataFrame([(T("2024-06-01 08:00:00"), [
        ("e1", (("V1", "L1", None, None), ("T1", "R1", "08:00", "20240601"), (45.0, 7.6, 90.0), 100)),
    ])], schemas.VEHICLE_FEED)
    snapshot.write.parquet(str(tmp_path / "snapshots"))
    flatten = parse(["flatten", "--kind", "positions", "--src", str(tmp_path / "snapshots"), "--dst", str(raw / "raw_vehicle_positions")])
    assert _flatten(flatten, spark) == 0 and _flatten(flatten, spark) == 0  # a retried command lands its rows once
    assert read_source(spark, flatten.dst).count() == 1
    fx.trip_updates(spark).write.parquet(str(raw / "raw_trip_updates"))
    fx.weather(spark).write.parquet(str(raw / "raw_weather"))

    # Three folds: the first batch, the same files again, other files.
    a = fx.alerts(spark)
    a.where("id <= 5").write.parquet(str(tmp_path / "b1"))
    a.write.parquet(str(tmp_path / "b2"))
    outcome = []
    for name, extra in (("b1", []), ("b1", []), ("b2", ["--compact"]), ("b1", ["--expire-days", "0"])):
        assert _fold(parse(["fold", "--batch", str(tmp_path / name), "--state", str(raw / "raw_alerts"), *extra]), spark) == 0
        outcome.append(capsys.readouterr().out.strip())
    n = a.where("id <= 5").count()
    assert outcome[0] == outcome[1] == f"alerts inserted: {n}, refreshed: 0"
    assert outcome[2] == f"alerts inserted: {a.count() - n}, refreshed: {n}"
    assert outcome[3] == "these files are in the table already"
    folded = {r.id: r.times_seen for r in sinks.alert_fold_table(spark, str(raw / "raw_alerts")).read().collect()}
    assert len(folded) == 11 and folded[1] == 6

    assert _refresh(parse(["refresh", "--gtfs", feed, "--store", str(tmp_path / "store")]), spark) == 0
    run = ["run", "--raw", str(raw), "--store", str(tmp_path / "store"), "--out", out, "--as-of", "2024-06-01 12:00:00", "--no-fail"]
    assert _run(parse(run), spark) == 0
    assert read_model(spark, out, "_checks").count() == 39
    assert read_model(spark, out, "stg_vehicle_positions").count() == 1
    first = rows(read_model(spark, out, "stg_trip_updates"))
    assert read_model(spark, out, "fct_route_performance").count() == 3
    assert _run(parse([*run, "--split-keys", "--approx", "--tz", "Europe/Rome"]), spark) == 0
    assert rows(read_model(spark, out, "stg_trip_updates")) == first


def test_command_line_with_incremental_history(spark, tmp_path, feed):
    raw, out = tmp_path / "raw", str(tmp_path / "out")
    landing.land_new_rows(fx.trip_updates(spark), str(raw / "raw_trip_updates"), "q", 0)
    for name, df in (("raw_vehicle_positions", fx.positions(spark)), ("raw_alerts", fx.alerts(spark)), ("raw_weather", fx.weather(spark))):
        df.write.parquet(str(raw / name))
    dates = [str(r[0]) if r[0] else "none" for r in fx.trip_updates(spark).select(F.to_date("fetched_at")).distinct().collect()]
    run = ["run", "--raw", str(raw), "--gtfs", feed, "--out", out, "--as-of", "2024-06-01 12:00:00", "--no-fail"]
    assert _run(parse(run), spark) == 0
    whole = rows(read_model(spark, out, "stg_trip_updates"))
    assert _run(parse([*run, "--history", str(tmp_path / "history"), "--dates", ",".join(dates)]), spark) == 0
    assert rows(read_model(spark, out, "stg_trip_updates")) == whole
