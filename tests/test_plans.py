"""Plan-shape checks on the registered queries."""

import contextlib
import io
import re

import pytest

from tramline.plans.queries import REGISTRY

SF = "/root/testdata/sf0.001"
MODELS = ["stg_vehicle_positions", "stg_weather", "stg_trip_updates", "stg_alerts", "stg_routes",
          "stg_stops", "route_performance", "hourly_service", "alert_impact"]


PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "MapInPandas", "MapInArrow", "FlatMapGroupsInArrow",
                "FlatMapGroupsInPandas", "PythonMapInArrow")


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_no_python_udf(spark, name):
    if name.startswith("stream_") or name in ("csv_reference", "csv_bulk", "append_snapshots",
                                              "evolve_schema", "full_refresh", "alert_upsert",
                                              "keyed_layout_join", "flatten_weather", "trip_history_slices"):
        pytest.skip("writes files; covered by the oracle test")
    p = plan(REGISTRY[name](spark, SF))
    for bad in PYTHON_NODES:
        assert bad not in p, f"{name} runs Python per row"


@pytest.mark.parametrize("name", MODELS)
def test_no_single_partition_exchange(spark, name):
    p = plan(REGISTRY[name](spark, SF))
    assert "SinglePartition" not in p, f"{name} funnels data through one partition"


def test_route_performance_plan(spark):
    p = plan(REGISTRY["route_performance"](spark, SF))
    # the partition-key filter of the latest/en-route rule reaches the scan
    assert "GreaterThan(l_linenumber,1)" in p
    assert "hashpartitioning(trip_id" in p
    # one percentile buffer, fed with value counts
    assert len(re.findall(r"partial_percentile\(", p)) == 1
    # the scan reads only the columns it needs
    assert "l_extendedprice" not in p and "l_tax" not in p


def test_keep_latest_window_uses_group_limit(spark):
    from tramline.plans import staging
    from tramline.sources import testdata as td
    p = plan(staging.stg_weather(td.weather(spark, SF), method="window"))
    assert "WindowGroupLimit" in p
    p = plan(staging.stg_weather(td.weather(spark, SF)))
    assert "Window" not in p and "max_by" in p  # default: partial aggregation, no sort


def test_bucketed_join_has_no_exchange(spark):
    p = plan(REGISTRY["keyed_layout_join"](spark, SF))
    assert "Exchange hashpartitioning" not in p


def test_joins_follow_the_size(spark):
    import fixtures as fx
    from tramline.operators.joins import join_dimension

    key = "spark.sql.autoBroadcastJoinThreshold"
    assert spark.conf.get(key) == "8MB"
    spark.conf.set(key, "1b")  # as for a dimension whose files are larger than the bound
    try:
        joined = join_dimension(fx.trip_updates(spark), fx.trips(spark), "trip_id", "left")
        assert "SortMergeJoin" in plan(joined)
        joined.collect()
        assert "BroadcastHashJoin" in plan(joined)  # the final plan, after measuring
    finally:
        spark.conf.set(key, "8MB")


WRITES = ("stream_", "csv_", "append_", "evolve_", "full_refresh", "alert_upsert", "keyed_layout", "flatten_weather",
          "dq_suite", "win_event_history_split", "backfill_job", "trip_history_slices")


def test_building_a_query_starts_no_job(spark):
    tracker = spark.sparkContext.statusTracker()
    for name in sorted(REGISTRY):
        if name.startswith(WRITES):
            continue  # sinks and streams are jobs by nature
        spark.sparkContext.setJobGroup(f"build-{name}", name)
        REGISTRY[name](spark, SF)
        assert list(tracker.getJobIdsForGroup(f"build-{name}")) == [], name
    spark.sparkContext.setJobGroup("tests", "tests")


def test_landed_reads_prune_dates(spark):
    import fixtures as fx
    from tramline.operators import sinks
    from tramline.session import scratch_dir

    path = scratch_dir(spark, "prune")
    sinks.append_snapshot(fx.positions(spark), path)
    recent = sinks.read_landed(spark, path, since="2024-10-27", until="2024-10-27")
    p = plan(recent)
    assert "PartitionFilters: [isnotnull(fetch_date" in p and "2024-10-27" in p
    assert sorted(r.id for r in recent.collect()) == [1, 2, 3, 4, 5]


def test_alert_impact_counts_stops_in_two_phases(spark):
    """JOIN-4: distinct stops and a left join; no window by alert."""
    p = plan(REGISTRY["alert_impact"](spark, SF))
    assert "Window" not in p and "LeftOuter" in p


def test_a_date_of_any_size_is_written_by_many_tasks(spark, tmp_path):
    """SRC-8: adaptive execution splits a rebalanced date."""
    from pyspark.sql import functions as F

    from tramline.operators import sinks
    rows = spark.range(400_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("text"),
                                       F.lit("2024-06-01 08:00:00").cast("timestamp_ntz").alias("fetched_at"))
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    old = spark.conf.get(name)
    try:
        spark.conf.set(name, "2m")
        sinks.append_snapshot(rows, str(tmp_path / "big"))
        sinks.append_snapshot(rows.limit(50), str(tmp_path / "small"))
    finally:
        spark.conf.set(name, old)
    folder = tmp_path / "big" / "fetch_date=2024-06-01"
    assert len(list(folder.glob("*.parquet"))) >= 8
    assert len(list((tmp_path / "small").glob("*/*.parquet"))) == 1
    assert sinks.read_landed(spark, str(tmp_path / "big")).count() == 400_000
