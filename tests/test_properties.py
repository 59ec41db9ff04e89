"""Randomized properties."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import rows
from tramline import schemas
from tramline.operators import upsert, windows
from tramline.plans import marts, staging

BASE = dt.datetime(2024, 3, 30, 22, 0, 0)
SETTINGS = settings(max_examples=6, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

history_rows = st.lists(
    st.tuples(
        st.sampled_from(["A", "B", "C"]),  # trip; A is made hot below
        st.integers(0, 3),  # stop
        st.one_of(st.none(), st.integers(-300, 300)),  # delay
        st.one_of(st.none(), st.integers(0, 600)),  # minutes after BASE (crosses DST)
    ),
    min_size=1, max_size=60,
)


@SETTINGS
@given(data=history_rows, hot_copies=st.integers(0, 40))
def test_history_properties(spark, data, hot_copies):
    data = data + [("A", 1, i % 7 - 3, i % 11) for i in range(hot_copies)]
    recs = [(i, t, s, d, None if m is None else BASE + dt.timedelta(minutes=m))
            for i, (t, s, d, m) in enumerate(data)]
    df = spark.createDataFrame(recs, "id long, trip_id string, stop_sequence int, d int, "
                                     "fetched_at timestamp_ntz")
    args = (["trip_id", "stop_sequence"], ["fetched_at", "id"], "d")
    simple = windows.observation_history(df, *args)
    split = windows.observation_history(df, *args, split=True, ranges=4)
    assert rows(split) == rows(simple)
    per_key = simple.groupBy("trip_id", "stop_sequence").agg(
        F.max("observation_number").alias("mx"), F.max("total_observations").alias("tot"),
        F.count_if(F.col("recency_rank") == 1).alias("latest"), F.count(F.lit(1)).alias("n"))
    for r in per_key.collect():
        assert r.mx == r.tot == r.n and r.latest == 1


alert_rows = st.lists(
    st.tuples(st.sampled_from(["A1", "A2"]), st.sampled_from(["h1", "h2"]),
              st.sampled_from([None, "R1"]), st.integers(0, 100), st.one_of(st.none(), st.integers(1, 3))),
    min_size=1, max_size=30,
)


@SETTINGS
@given(data=alert_rows, cut=st.integers(0, 30))
def test_fold_split_anywhere(spark, data, cut):
    recs = [(i, a, h, "C", "E", "S", "x", None, None, 0, 1, r, None, None, None, None, n,
             BASE + dt.timedelta(minutes=m)) for i, (a, h, r, m, n) in enumerate(data)]
    df = spark.createDataFrame(recs, schemas.RAW_ALERTS)
    first, second = df.where(F.col("id") < cut), df.where(F.col("id") >= cut)
    whole = upsert.fold_alerts(None, df)
    assert rows(upsert.fold_alerts(upsert.fold_alerts(None, first), second)) == rows(whole)
    assert rows(upsert.fold_alerts(upsert.fold_alerts(None, second), first)) == rows(whole)


@SETTINGS
@given(delays=st.lists(st.integers(-400, 400).filter(lambda x: x != 0), min_size=1, max_size=40))
def test_punctuality_shares_sum_to_100(spark, delays):
    recs = [(i, f"T{i}", "", "", "", "V", "", "", "2", 2, d, d, 0, BASE) for i, d in enumerate(delays)]
    tu = spark.createDataFrame(recs, schemas.RAW_TRIP_UPDATES)
    trips = tu.select("trip_id", F.lit("R1U").alias("route_id"), F.lit("0").alias("direction_id"),
                      F.lit("x").alias("trip_headsign"))
    routes = spark.createDataFrame([("R1U", "1", "1", "One", "", "3", "", "", "", BASE)],
                                   "route_id string, agency_id string, route_short_name string, "
                                   "route_long_name string, route_desc string, route_type string, "
                                   "route_url string, route_color string, route_text_color string, "
                                   "loaded_at timestamp_ntz")
    r = marts.fct_route_performance(staging.stg_trip_updates(tu, trips),
                                    staging.stg_routes(routes)).first()
    assert abs(r.pct_late + r.pct_early + r.pct_on_time - 100.0) <= 0.15
    assert r.observations == len(delays)
