"""Hand-written landed rows for the model tests (FIXTURES.md section 5)."""

import datetime as dt

from tramline import schemas

T = dt.datetime.fromisoformat


def trip_updates(spark):
    # (id, trip, route(feed), start_time, start_date, vehicle, label, plate, access, stop, arr, dep, gps, fetched)
    r = [
        # G-1: three fetches of (T1, 2): -30, 90, 0 -> latest is 0, the key drops from marts.
        (1, "T1", "", "", "20240601", "V1", "", "", "2", 2, -30, -30, 0, T("2024-06-01 08:00:00")),
        (2, "T1", "", "", "20240601", "V1", "", "", "2", 2, 90, 90, 0, T("2024-06-01 08:05:00")),
        (3, "T1", "", "", "20240601", "V1", "", "", "2", 2, 0, 0, 0, T("2024-06-01 08:10:00")),
        # (T1, 3): a null delay in the middle; lag and first keep nulls.
        (4, "T1", "", "", "20240601", "V1", "", "", "3", 3, 120, None, 0, T("2024-06-01 08:00:00")),
        (5, "T1", "", "", "20240601", "V1", "", "", "3", 3, None, None, 0, T("2024-06-01 08:05:00")),
        (6, "T1", "", "", "20240601", "V1", "", "", "3", 3, 200, None, 0, T("2024-06-01 08:10:00")),
        # G-3: a tie on fetched_at at (T2, 2); the larger id is the latest.
        (7, "T2", "", "", "20240601", "V2", "", "", "0", 2, 30, 30, 0, T("2024-06-01 09:00:00")),
        (8, "T2", "", "", "20240601", "V2", "", "", "0", 2, 61, 61, 0, T("2024-06-01 09:00:00")),
        # stop_sequence 0, 1 and null
        (9, "T2", "", "", "20240601", "V2", "", "", "0", 0, 15, 15, 0, T("2024-06-01 09:00:00")),
        (10, "T2", "", "", "20240601", "V2", "", "", "0", 1, 15, 15, 0, T("2024-06-01 09:00:00")),
        (11, "T2", "", "", "20240601", "V2", "", "", "0", None, 15, 15, 0, T("2024-06-01 09:00:00")),
        # G-8: unmatched trip keeps a null route.
        (12, "TX", "", "", "20240601", "V3", "", "", "0", 4, 100, 100, 0, T("2024-06-01 09:00:00")),
        # G-2: the same trip id on another service date continues the history.
        (13, "T3", "", "", "20240601", "V4", "", "", "2", 5, -90, -90, 0, T("2024-06-01 10:00:00")),
        (14, "T3", "", "", "20240602", "V4", "", "", "2", 5, -70, -70, 0, T("2024-06-02 10:00:00")),
        # G-7: two latest delays on route R2 whose median ends in .5 (61 and 120 -> 90.5 -> 90).
        (15, "T4", "", "", "20240601", "V5", "", "", "3", 2, 120, 120, 0, T("2024-06-01 11:00:00")),
    ]
    return spark.createDataFrame(r, schemas.RAW_TRIP_UPDATES)


def trips(spark):
    r = [("T1", "R1U", "0", "North"), ("T2", "R2E", "1", "South"), ("T3", "R3", "0", "East"),
         ("T4", "R2E", "0", "West")]
    return spark.createDataFrame(r, "trip_id string, route_id string, direction_id string, "
                                    "trip_headsign string")


def routes(spark):
    r = [
        ("R1U", "1", "1", "One", "", "0", "", "FF0000", "", T("2024-06-01 00:00:00")),
        ("R2E", "1", "2N", "Two", "", "3", "", "", "", T("2024-06-01 00:00:00")),
        ("R3", "1", None, "Three", "", "11", "", "", "", T("2024-06-01 00:00:00")),
        ("R9U", "1", "9", "Nine", "", "7", "", "", "000000", T("2024-06-01 00:00:00")),
    ]
    return spark.createDataFrame(r, "route_id string, agency_id string, route_short_name string, "
                                    "route_long_name string, route_desc string, route_type string, "
                                    "route_url string, route_color string, route_text_color string, "
                                    "loaded_at timestamp_ntz")


def stops(spark):
    r = [
        ("S1", "1", "Uno", "", "45.07", "7.68", "", "", "", "", "", "1"),
        ("S2", "2", "Due", "", "", "7.68", "", "", "", "", "", "2"),  # blank lat -> dropped
        ("S3", "3", "Tre", "", "45.07", None, "", "", "", "", "", "0"),  # null lon -> dropped
        ("S4", "4", "", "", "45.1", "7.7", "", "", "1", "S1", "", ""),
    ]
    df = spark.createDataFrame(r, "stop_id string, stop_code string, stop_name string, "
                                  "stop_desc string, stop_lat string, stop_lon string, "
                                  "zone_id string, stop_url string, location_type string, "
                                  "parent_station string, stop_timezone string, "
                                  "wheelchair_boarding string")
    from pyspark.sql import functions as F
    return df.withColumn("loaded_at", F.lit(T("2024-06-01 00:00:00")))


def positions(spark):
    r = [
        (1, "V1", "a", "R1U", "T1", "", "", 45.07, 7.68, 90.0, 1717228800, T("2024-10-27 00:30:00")),
        (2, "V2", "b", "R1U", "", "", "", 45.07, 7.68, 0.0, 0, T("2024-10-27 01:30:00")),
        (3, "V3", "c", "", None, "", "", 0.0, 0.0, 0.0, 0, T("2024-10-27 01:40:00")),
        (4, "V4", "d", "R2E", "T2", "", "", 0.0, 7.68, 0.0, 0, T("2024-10-27 01:45:00")),
        (5, "V5", "e", "R2E", "T2", "", "", 45.07, None, 0.0, 0, T("2024-10-27 01:50:00")),
        (6, "V1", "a", "", "T1", "", "", 45.07, 7.68, 0.0, 0, T("2024-10-26 10:00:00")),  # Saturday
        (7, "V1", "a", "R1U", "T1", "", "", 45.07, 7.68, 0.0, 0, T("2024-10-28 10:00:00")),  # Monday
    ]
    return spark.createDataFrame(r, schemas.RAW_VEHICLE_POSITIONS)


def weather(spark):
    r = [
        (1, T("2024-06-01 10:00:00"), 20.0, 0.0, 5.0, 0, T("2024-06-01 10:05:00")),
        (2, T("2024-06-01 10:00:00"), 21.0, 0.5, 6.0, 61, T("2024-06-01 10:10:00")),  # later fetch wins
        (3, T("2024-06-01 10:15:00"), 22.0, 0.0, 6.0, 2, T("2024-06-01 10:20:00")),
        (4, T("2024-06-01 10:30:00"), 22.5, 0.0, 6.0, 2, T("2024-06-01 10:35:00")),
        (5, T("2024-06-01 10:45:00"), 23.0, 0.0, 6.0, 61, T("2024-06-01 10:50:00")),
    ]
    return spark.createDataFrame(r, schemas.RAW_WEATHER)


def alerts(spark):
    c = ("WEATHER", "DETOUR", "WARNING", "H", None, None)
    r = [
        # G-12: one alert, two content versions; the later one ends later.
        (1, "A1", "h1", *c, 1717200000, 1717286400, "R1U", None, None,
         T("2024-06-01 08:00:00"), T("2024-06-01 09:00:00"), 3, T("2024-06-01 08:00:00")),
        (2, "A1", "h2", "STRIKE", "DETOUR", "WARNING", "H2", None, None, 1717200000, 1717372800,
         "R1U", None, None, T("2024-06-01 10:00:00"), T("2024-06-01 11:00:00"), 2,
         T("2024-06-01 10:00:00")),
        # G-10: end 0 -> 1970, never active, negative duration.
        (3, "A2", "h3", *c, 1717200000, 0, "R2E", None, None, None, None, None,
         T("2024-06-01 08:00:00")),
        # no entity; stop-only; trip-only; route + stop (G-19)
        (4, "A3", "h4", *c, 1717200000, 1717286400, None, None, None, None, None, None,
         T("2024-06-01 08:00:00")),
        (5, "A4", "h5", *c, 1717200000, 1717286400, None, "S1", None, None, None, None,
         T("2024-06-01 08:00:00")),
        (6, "A5", "h6", *c, 1717200000, 1717286400, None, None, "T1", None, None, None,
         T("2024-06-01 08:00:00")),
        # G-21: an alert naming 2 routes and 3 stops (one row with route + stop).
        (7, "A6", "h7", *c, 1717200000, 1717286400, "R1U", "S1", None, None, None, None,
         T("2024-06-01 08:00:00")),
        (8, "A6", "h7", *c, 1717200000, 1717286400, "R2E", None, None, None, None, None,
         T("2024-06-01 08:00:00")),
        (9, "A6", "h7", *c, 1717200000, 1717286400, None, "S2", None, None, None, None,
         T("2024-06-01 08:00:00")),
        (10, "A6", "h7", *c, 1717200000, 1717286400, None, "S3", None, None, None, None,
         T("2024-06-01 08:00:00")),
        # G-27: unknown route drops from the impact mart.
        (11, "A7", "h8", *c, 1717200000, 1717286400, "RZZ", None, None, None, None, None,
         T("2024-06-01 08:00:00")),
    ]
    return spark.createDataFrame(r, schemas.RAW_ALERTS)
