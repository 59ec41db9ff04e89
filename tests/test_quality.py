import pytest

import fixtures as fx
from tramline.operators import quality
from tramline.plans import marts, staging


def models(spark):
    tu = staging.stg_trip_updates(fx.trip_updates(spark), fx.trips(spark))
    routes = staging.stg_routes(fx.routes(spark))
    alerts = staging.stg_alerts(fx.alerts(spark), as_of="2024-06-01 12:00:00")
    pos = staging.stg_vehicle_positions(fx.positions(spark))
    wx = staging.stg_weather(fx.weather(spark))
    return {
        "stg_vehicle_positions": pos, "stg_weather": wx, "stg_trip_updates": tu,
        "stg_alerts": alerts, "stg_routes": routes, "stg_stops": staging.stg_stops(fx.stops(spark)),
        "fct_route_performance": marts.fct_route_performance(tu, routes),
        "fct_hourly_service": marts.fct_hourly_service(pos, tu, wx),
        "fct_alert_impact": marts.fct_alert_impact(alerts, routes),
    }


def test_suite_has_39_checks():
    assert len(quality.SUITE) == 39
    kinds = [c.test for c in quality.SUITE]
    assert (kinds.count("not_null"), kinds.count("unique"), kinds.count("accepted_values")) == (30, 6, 3)


def test_suite_flags_known_failures(spark):
    res = {(r.model, r.column_name, r.test): r.failures
           for r in quality.run_suite(models(spark)).collect()}
    assert len(res) == 39
    # The unmatched trip TX has no route (G-8); R3's short name is null.
    assert res[("stg_trip_updates", "route_id", "not_null")] == 1
    assert res[("stg_routes", "route_short_name", "not_null")] == 1
    assert res[("fct_route_performance", "route_short_name", "not_null")] == 1
    failing = {k for k, v in res.items() if v}
    assert failing == {("stg_trip_updates", "route_id", "not_null"),
                       ("stg_routes", "route_short_name", "not_null"),
                       ("fct_route_performance", "route_short_name", "not_null")}
    with pytest.raises(AssertionError):
        quality.assert_passed(quality.run_suite(models(spark)))


def test_each_check_kind_fails(spark):
    df = spark.createDataFrame([(1, "a", 5), (1, None, 30), (2, "b", None)],
                               "k int, s string, h int")
    assert quality.not_null_failures(df, "s").count() == 1
    assert [tuple(r) for r in quality.unique_failures(df, "k").collect()] == [(1, 2)]
    assert quality.accepted_values_failures(df, "h", range(24)).count() == 1  # null passes
    checks = [quality.Check("t", "s", "not_null"), quality.Check("t", "k", "unique"),
              quality.Check("t", "h", "accepted_values", tuple(range(24)))]
    got = {r.test: r.failures for r in quality.run_checks(df, checks).collect()}
    assert got == {"not_null": 1, "unique": 1, "accepted_values": 1}


def test_observed_checks_during_refresh(spark, tmp_path):
    from tramline.plans.catalog import ModelCatalog, default_models, refresh
    cat = ModelCatalog(spark, {
        "raw_vehicle_positions": fx.positions(spark), "raw_weather": fx.weather(spark),
        "raw_trip_updates": fx.trip_updates(spark), "raw_alerts": fx.alerts(spark),
        "gtfs_routes": fx.routes(spark), "gtfs_stops": fx.stops(spark),
        "gtfs_trips": fx.trips(spark)}, default_models(as_of="2024-06-01 12:00:00"))
    metrics = {}
    out = refresh(cat, str(tmp_path), metrics=metrics)
    assert metrics["stg_trip_updates"]["route_id.not_null"] == 1
    assert metrics["stg_alerts"]["entity_type.accepted_values"] == 0
    assert out["fct_route_performance"].count() == 3  # marts read the stored staging tables


def test_grain_and_unmatched(spark):
    alerts = staging.stg_alerts(fx.alerts(spark), as_of="2024-06-01 12:00:00")
    routes = staging.stg_routes(fx.routes(spark))
    assert [tuple(r) for r in marts.unmatched_route_alerts(alerts, routes).collect()] == [("RZZ", "A7")]
    impact = marts.fct_alert_impact(alerts, routes)
    assert quality.unique_combination_failures(impact, ["route_id", "alert_id"]).count() == 0


def test_run_models_and_tests_gate(spark, tmp_path):
    from tramline.plans.catalog import ModelCatalog, default_models, run_models_and_tests
    def catalog():
        return ModelCatalog(spark, {
            "raw_vehicle_positions": fx.positions(spark), "raw_weather": fx.weather(spark),
            "raw_trip_updates": fx.trip_updates(spark), "raw_alerts": fx.alerts(spark),
            "gtfs_routes": fx.routes(spark), "gtfs_stops": fx.stops(spark),
            "gtfs_trips": fx.trips(spark)}, default_models(as_of="2024-06-01 12:00:00"))
    res = run_models_and_tests(catalog(), str(tmp_path / "a"), fail=False)
    got = {(r.model, r.column_name, r.test): r.failures for r in res.collect()}
    assert len(got) == 39 and sum(1 for v in got.values() if v) == 3
    assert got[("stg_trip_updates", "route_id", "not_null")] == 1
    with pytest.raises(AssertionError):
        run_models_and_tests(catalog(), str(tmp_path / "b"))


def test_a_failing_run_leaves_readers_on_the_old_version(spark, tmp_path):
    from tramline.plans.catalog import ModelCatalog, default_models, read_model, run_models_and_tests

    def catalog(alerts):
        return ModelCatalog(spark, {
            "raw_vehicle_positions": fx.positions(spark), "raw_weather": fx.weather(spark),
            "raw_trip_updates": fx.trip_updates(spark), "raw_alerts": alerts, "gtfs_routes": fx.routes(spark),
            "gtfs_stops": fx.stops(spark), "gtfs_trips": fx.trips(spark)}, default_models(as_of="2024-06-01 12:00:00"))
    root = str(tmp_path)
    with pytest.raises(FileNotFoundError):
        read_model(spark, root, "stg_alerts")
    run_models_and_tests(catalog(fx.alerts(spark)), root, fail=False)
    before = read_model(spark, root, "stg_alerts").count()
    with pytest.raises(AssertionError):  # an unmatched trip fails the suite
        run_models_and_tests(catalog(fx.alerts(spark).limit(1)), root)
    assert read_model(spark, root, "stg_alerts").count() == before
    run_models_and_tests(catalog(fx.alerts(spark).limit(1)), root, fail=False)
    assert read_model(spark, root, "stg_alerts").count() == 1 and read_model(spark, root, "_checks").count() == 39


def test_size_for_input(spark):
    from tramline.session import size_for_input
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        assert size_for_input(spark, 100 << 40) == 409600  # 100 TB / 256 MB
        assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == str(256 << 20)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", old)
