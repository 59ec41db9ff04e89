"""Time expressions. Inputs and outputs are naive UTC wall clock (NTZ).

The session time zone must be UTC (see ``tramline.session``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LOCAL_TZ = "Europe/Rome"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def epoch_to_utc(seconds) -> Column:
    """Unix seconds -> UTC wall clock (FN-1)."""
    return F.timestamp_seconds(_c(seconds)).cast("timestamp_ntz")


def utc_seconds(ts) -> Column:
    """UTC wall clock -> whole unix seconds (inverse of ``epoch_to_utc``)."""
    return F.unix_seconds(_c(ts).cast("timestamp"))


def to_local(ts, tz: str = LOCAL_TZ) -> Column:
    """UTC wall clock -> wall clock in ``tz``, DST-aware, stays NTZ (FN-2).

    At the autumn change two UTC hours map onto the same local hour (G-6).
    Same result as ``convert_timezone('UTC', tz, ts)`` under a UTC session,
    at about a third of its cost per row.
    """
    return F.from_utc_timestamp(_c(ts).cast("timestamp"), tz).cast("timestamp_ntz")


def hour_of(ts) -> Column:
    """``extract(hour ...)`` as INT (FN-3)."""
    return F.hour(_c(ts))


def day_of_week(ts) -> Column:
    """``extract(dow ...)``: Sunday = 0 ... Saturday = 6 (FN-4, G-5)."""
    return F.dayofweek(_c(ts)) - F.lit(1)


def is_weekend(ts) -> Column:
    """Saturday or Sunday."""
    return day_of_week(ts).isin(0, 6)


# FIXED VALUES: English day names, Sunday first, blank-padded to 9 characters
# as the reference's to_char(ts, 'Day') prints them.
DAY_NAMES = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]


def day_name(ts) -> Column:
    """Day name padded to 9 characters (FN-5); a lookup by day of week,
    cheaper than formatting each timestamp."""
    names = F.array(*[F.lit(f"{d:<9}") for d in DAY_NAMES])
    return F.element_at(names, F.dayofweek(_c(ts)))


def hour_bucket(ts) -> Column:
    """``date_trunc('hour', ts)`` kept as NTZ (FN-6)."""
    return F.date_trunc("hour", _c(ts)).cast("timestamp_ntz")


def utc_micros(ts) -> Column:
    return F.unix_micros(_c(ts).cast("timestamp"))


def seconds_between(end, start) -> Column:
    """``end - start`` in seconds as DOUBLE (exact microseconds / 1e6) (FN-7)."""
    return (utc_micros(end) - utc_micros(start)) / F.lit(1_000_000)


def interval_between(end, start) -> Column:
    """``end - start`` as a day-time interval (FN-7)."""
    return _c(end) - _c(start)


def interval_text(interval) -> Column:
    """A day-time interval as text, ``[-]days hh:mm:ss`` (FN-7), for outputs whose readers don't
    know the type; null stays null."""
    parts = [F.abs(F.extract(F.lit(p), _c(interval))) for p in ("DAY", "HOUR", "MINUTE", "SECOND")]
    sign = F.when(_c(interval) < F.expr("INTERVAL '0' SECOND"), F.lit("-")).otherwise(F.lit(""))
    return F.concat(sign, F.format_string("%d %02d:%02d:%02d", *[p.cast("long") for p in parts]),
                    F.when(_c(interval).isNull(), F.lit(None).cast("string")).otherwise(F.lit("")))


def within(now, start, end) -> Column:
    """``now BETWEEN start AND end`` (FN-8); null if a bound is null."""
    return _c(now).between(_c(start), _c(end))
