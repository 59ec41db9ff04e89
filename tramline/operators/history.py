"""Incremental history of keyed observations (WIN-1..5, MOD-3).

The history of a key is cut at dates, which come first in its order. Each date's slice is
windowed by itself and stored, with a carry-over record per key: how many observations the
date has, its first value and its last. The records in front of a date add up to what a
row's number, previous and first value need, and all of a key's records to its total; so a
new date, or a late one, windows its own raw rows only, and no older slice is read or rewritten.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tramline.operators.storage import delete, folders
from tramline.operators.windows import observation_history

PARTITION_COL = "fetch_date"
METRICS = ("observation_number", "total_observations", "previous_value", "first_value", "recency_rank")


def _folder(date: dt.date | None) -> str:
    return f"{PARTITION_COL}={'__HIVE_DEFAULT_PARTITION__' if date is None else date.isoformat()}"


class HistorySlices:
    """Slices of ``keys``' history under ``path``, one per fetch date.

    ``order`` must begin with ``time``, whose date is the slice: rows without a time are
    the last slice, as nulls come last in the order. ``split`` cuts keys of any size
    within a date (see ``observation_history``). ``grain`` (day, week, month, year) is the length
    of a slice, which is named by its first day: tables with few rows a day take longer ones.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], order: Sequence[str], value: str,
                 time: str = "fetched_at", split: bool = False, grain: str = "day"):
        if order[0] != time:
            raise ValueError(f"the order must begin with {time}")
        self.spark, self.path = spark, path
        self.keys, self.order, self.value, self.split, self.grain = list(keys), list(order), value, split, grain

    def slice_of(self, date: Column) -> Column:
        """The first day of a date's slice."""
        return date if self.grain == "day" else F.trunc(date, self.grain)

    def update(self, rows: DataFrame, dates: Sequence[dt.date | None]) -> None:
        """Make the slices of ``dates`` anew from their raw ``rows`` (a table with ``fetch_date``; of a
        partitioned one only these dates' folders are read). A repeated update gives the same."""
        some = [d for d in dates if d is not None]
        date = self.slice_of(F.col(PARTITION_COL))
        wanted = date.isin(some) if some else F.lit(False)
        if None in dates:
            wanted |= date.isNull()
        raw, keys = rows.where(wanted).withColumn(PARTITION_COL, date), [PARTITION_COL, *self.keys]
        if not self.split:
            # One exchange for the window and the write: a task holds neighbouring slices, or a range of one.
            raw = raw.repartitionByRange(*keys)
        own = observation_history(raw, keys, self.order, self.value, split=self.split)
        for date in dates:  # an earlier slice of these dates, if there is one
            for kind in ("slices", "carry"):
                delete(self.spark, f"{self.path}/{kind}/{_folder(date)}")
        if self.split:  # its parts are dealt by key
            own = own.hint("rebalance", PARTITION_COL)
        own.write.mode("append").partitionBy(PARTITION_COL).parquet(f"{self.path}/slices")
        slices = self._slices(dates)
        if slices is None:
            return
        # A key's last row of a date holds the whole record; a file's records go to one file.
        carry = slices.where(F.col("recency_rank") == 1).select(
            PARTITION_COL, *self.keys, F.col("total_observations").alias("n"),
            F.struct(F.col("first_value").alias("v")).alias("first"), F.struct(F.col(self.value).alias("v")).alias("last"))
        carry.write.mode("append").partitionBy(PARTITION_COL).parquet(f"{self.path}/carry")

    def _slices(self, dates: Sequence[dt.date | None] | None) -> DataFrame | None:
        known = [f.name for f in folders(self.spark, f"{self.path}/slices") if f.name.startswith(PARTITION_COL)]
        names = known if dates is None else [n for n in (_folder(d) for d in dates) if n in known]
        if not names:
            return None
        found = self.spark.read.option("basePath", f"{self.path}/slices").parquet(*[f"{self.path}/slices/{n}" for n in names])
        return found.withColumn(PARTITION_COL, F.col(PARTITION_COL).cast("date"))  # untyped where all folders are of no date

    def read(self, dates: Sequence[dt.date | None] | None = None, by: Sequence[str] | None = None) -> DataFrame:
        """The rows of ``dates`` (all by default) with the metrics of the whole history, as
        ``observation_history`` over all raw rows gives them. ``by``, some of the keys, is how
        rows are dealt to tasks (by all keys if not given): a join on it needs no other exchange.
        With ``split`` rows meet their offsets in a join, which deals a key's dates to many tasks."""
        rows = self._slices(dates)
        if rows is None:
            raise FileNotFoundError(f"no slice of these dates under {self.path}")
        carry = self.spark.read.parquet(f"{self.path}/carry").withColumn(PARTITION_COL, F.col(PARTITION_COL).cast("date"))
        if dates is not None:
            key = F.struct(*self.keys).alias("_key")  # nulls equal each other, as in a window
            carry = carry.withColumn("_key", key).join(rows.select(key).distinct(), "_key", "left_semi").drop("_key")
        found = self._joined(rows, carry) if self.split else self._in_line(rows, carry, by or self.keys)
        number = (F.col("observation_number") + F.col("_offset")).cast("int")
        kept = [c for c in rows.columns if c not in METRICS and c != PARTITION_COL]
        return found.select(
            *kept, PARTITION_COL, number.alias("observation_number"), F.col("_total").alias("total_observations"),
            F.when(F.col("observation_number") == 1, F.col("_before.v")).otherwise(F.col("previous_value")).alias("previous_value"),
            F.col("_first.v").alias("first_value"), (F.col("_total") - number + F.lit(1)).alias("recency_rank"))

    def _in_line(self, rows: DataFrame, carry: DataFrame, by: Sequence[str]) -> DataFrame:
        """Rows with their offsets, by one exchange of rows and records together: in a key's line
        each date's rows stand before its record."""
        records = carry.select(PARTITION_COL, *self.keys, F.col("n").alias("_n"), F.col("first").alias("_one"), F.col("last").alias("_last"))
        line = rows.drop("total_observations", "first_value", "recency_rank").unionByName(records, allowMissingColumns=True)
        w = Window.partitionBy(*self.keys).orderBy(F.col(PARTITION_COL).asc_nulls_last(), F.col("_n").isNotNull())
        ahead = w.rowsBetween(Window.unboundedPreceding, -1)
        whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        return line.repartition(*by).select(
            "*", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_offset"),
            F.last("_last", ignorenulls=True).over(ahead).alias("_before"),
            F.first("_one", ignorenulls=True).over(whole).alias("_first"),
            F.sum("_n").over(whole).alias("_total")).where(F.col("_n").isNull())

    def _joined(self, rows: DataFrame, carry: DataFrame) -> DataFrame:
        """Rows with their offsets, by a join on key and date."""
        key, day = F.struct(*self.keys).alias("_key"), F.struct(PARTITION_COL).alias("_day")
        by = Window.partitionBy("_key").orderBy(F.col(PARTITION_COL).asc_nulls_last())
        whole = by.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        offsets = carry.withColumn("_key", key).select(
            "_key", day,
            F.coalesce(F.sum("n").over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_offset"),
            F.lag("last").over(by).alias("_before"), F.first("first").over(whole).alias("_first"),
            F.sum("n").over(whole).alias("_total"))
        return rows.withColumn("_key", key).withColumn("_day", day).join(offsets, ["_key", "_day"])
