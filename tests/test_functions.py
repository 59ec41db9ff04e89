import hashlib

import pytest
from pyspark.sql import functions as F
from pyspark.errors import PySparkException

from conftest import ts
from tramline.functions import codes, numeric, text, time


def one(spark, expr, data=None, schema="x string"):
    df = spark.createDataFrame(data or [(None,)], schema)
    return df.select(expr.alias("v")).first()["v"]


def test_epoch_and_local_time_across_dst(spark):
    # G-6: both 00:30 and 01:30 UTC on the autumn change are 02:30 local.
    df = spark.createDataFrame([(ts("2024-10-27 00:30:00"),), (ts("2024-10-27 01:30:00"),),
                                (ts("2024-07-01 10:00:00"),), (ts("2024-01-15 10:00:00"),)],
                               "t timestamp_ntz")
    got = [r[0] for r in df.select(time.to_local("t")).collect()]
    assert got == [ts("2024-10-27 02:30:00"), ts("2024-10-27 02:30:00"),
                   ts("2024-07-01 12:00:00"), ts("2024-01-15 11:00:00")]
    assert one(spark, time.epoch_to_utc(F.lit(0))) == ts("1970-01-01 00:00:00")
    assert one(spark, time.epoch_to_utc(F.lit(1700000000))) == ts("2023-11-14 22:13:20")


def test_day_of_week_and_padded_name(spark):
    # G-5 / FN-4 / FN-5: Sunday = 0, names padded to 9 characters.
    df = spark.createDataFrame([(ts("2024-06-01 12:00:00"),), (ts("2024-06-02 12:00:00"),),
                                (ts("2024-06-05 12:00:00"),)], "t timestamp_ntz")
    got = df.select(time.day_of_week("t"), time.day_name("t"), time.is_weekend("t")).collect()
    assert [tuple(r) for r in got] == [(6, "Saturday ", True), (0, "Sunday   ", True),
                                       (3, "Wednesday", False)]


def test_hour_bucket_stays_ntz(spark):
    df = spark.createDataFrame([(ts("2024-06-01 12:34:56"),)], "t timestamp_ntz")
    out = df.select(time.hour_bucket("t").alias("h"))
    assert out.schema["h"].dataType.simpleString() == "timestamp_ntz"
    assert out.first()["h"] == ts("2024-06-01 12:00:00")


def test_rounding_rules(spark):
    # G-7: averages half away from zero, percentiles half to even, numeric via decimal.
    df = spark.createDataFrame([(2.5, -2.5, 0.24999999999999997, -0.4)], "a double, b double, c double, d double")
    r = df.select(numeric.round_half_away("a"), numeric.round_half_away("b"),
                  numeric.round_half_even("a"), numeric.round_half_even("b"),
                  numeric.round_numeric("c", 1), numeric.round_half_even("d")).first()
    assert tuple(r) == (3.0, -3.0, 2.0, -2.0, 0.3, 0.0)
    assert str(r[5]) == "0.0"  # no negative zero


def test_pct_exact_and_zero_guard(spark):
    df = spark.createDataFrame([(1, 16), (7, 2000), (1, 0), (1, 3)], "a long, b long")
    got = [r[0] for r in df.select(numeric.pct("a", "b")).collect()]
    assert got == [6.3, 0.4, None, 33.3]


def test_route_codes(spark):
    df = spark.createDataFrame(
        [("0", "10U", "N1"), ("3", "4E", "12"), ("11", "7", None), (None, None, "2N")],
        "t string, r string, s string")
    got = df.select(codes.route_mode("t"), codes.service_area("r"), codes.is_night_route("s"))
    assert [tuple(x) for x in got.collect()] == [
        ("tram", "urban", True), ("bus", "extra_urban", False), ("other", "other", None),
        ("other", "other", True)]


def test_weather_condition_ranges(spark):
    data = [(c,) for c in (0, 2, 45, 57, 60, 67, 77, 82, 86, 99, None)]
    df = spark.createDataFrame(data, "c int")
    got = [r[0] for r in df.select(codes.weather_condition("c")).collect()]
    assert got == ["clear", "cloudy", "fog", "drizzle", "other", "rain", "snow", "rain_showers",
                   "snow_showers", "thunderstorm", "other"]


def test_accessibility_codes(spark):
    df = spark.createDataFrame([("0",), ("1",), ("2",), ("3",), ("",)], "c string")
    feed = [r[0] for r in df.select(codes.feed_accessibility("c")).collect()]
    stop = [r[0] for r in df.select(codes.stop_boarding("c")).collect()]
    assert feed == [None, None, True, False, None]
    assert stop == [None, True, False, None, None]


def test_enum_names_default_and_strict(spark):
    df = spark.createDataFrame([(None, 4, None), (3, None, 4)], "c int, e int, s int")
    got = df.select(codes.cause_name("c"), codes.effect_name("e"), codes.severity_name("s"))
    assert [tuple(r) for r in got.collect()] == [
        ("UNKNOWN_CAUSE", "DETOUR", "UNKNOWN_SEVERITY"),
        ("TECHNICAL_PROBLEM", "UNKNOWN_EFFECT", "SEVERE")]
    bad = spark.createDataFrame([(99,)], "c int")
    with pytest.raises(PySparkException):
        bad.select(codes.cause_name("c")).collect()
    assert bad.select(codes.cause_name("c", strict=False)).first()[0] is None


def test_entity_type_precedence(spark):
    df = spark.createDataFrame([("r", "s", "t"), (None, "s", "t"), (None, None, "t"),
                                (None, None, None)], "r string, s string, t string")
    got = [r[0] for r in df.select(codes.entity_type("r", "s", "t")).collect()]
    assert got == ["route", "stop", "trip", "unknown"]


def test_content_hash_matches_python(spark):
    fields = ("WEATHER", "DETOUR", "INFO", "Header", None, "u", 100, None)
    df = spark.createDataFrame([fields], "a string, b string, c string, d string, e string, "
                                         "f string, g long, h long")
    got = df.select(text.content_hash(*df.columns)).first()[0]
    want = hashlib.sha256("|".join(str(x) for x in fields).encode("utf-8")).hexdigest()
    assert got == want


def test_pick_translation(spark):
    schema = "t array<struct<text:string,language:string>>"
    df = spark.createDataFrame([
        ([("Hello", "en"), ("Ciao", "it")],),
        ([("Hello", "en")],),
        ([],),
        (None,),
        ([("", "it"), ("Hello", "en")],),  # G-15: preferred match wins even if blank
    ], schema)
    got = [r[0] for r in df.select(text.pick_translation("t")).collect()]
    assert got == ["Ciao", "Hello", None, None, ""]


def test_blank_helpers(spark):
    df = spark.createDataFrame([("",), (None,), ("x",), ("1.5",)], "s string")
    got = df.select(text.blank_to_null("s"), text.has_text("s")).collect()
    assert [tuple(r) for r in got] == [(None, False), (None, False), ("x", True), ("1.5", True)]
    assert [r[0] for r in df.select(text.text_to_double(F.when(F.col("s") != "x", F.col("s"))))
            .collect()] == [None, None, None, 1.5]


def test_intervals_as_text(spark):
    from tramline.functions.time import interval_text
    df = spark.sql("SELECT * FROM VALUES (INTERVAL '1 02:03:04' DAY TO SECOND), (INTERVAL '-0 00:00:09' DAY TO SECOND), "
                   "(INTERVAL '0 00:00:00' DAY TO SECOND), (CAST(NULL AS INTERVAL DAY TO SECOND)), (INTERVAL '400 23:59:59.9' DAY TO SECOND) AS t(i)")
    assert [r[0] for r in df.select(interval_text("i")).collect()] == ["1 02:03:04", "-0 00:00:09", "0 00:00:00", None, "400 23:59:59"]
