"""Landing rows once (STR-6, SRC-8): batches with names, and an index of landed keys by date.

Rows lie in ``rows/fetch_date=<d>/source=<s>/batch_id=<n>``, their keys in ``keys/fetch_date=<d>/
source=<s>/entry=<e>``. A batch reads the keys of its own dates only. Each source merges its
entries of a date into one sorted file when there are many, so the work of a batch
follows its own rows and the keys of its dates, not the number of batches so far. Merged
entries are deleted one merge later; a key that is listed twice does no harm. A batch may have
thousands of dates (a backfill): each is written by the task that holds it, and the folders
of all are listed, read and merged at once.

A batch that fails or is retried replaces its own rows and keys. Two queries may land into
one folder one after the other; at the very same time each sees only what the other has
finished.
"""

from __future__ import annotations

import datetime as dt
from collections import defaultdict
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline.operators.storage import BATCH_COL, SOURCE_COL, delete, matching

PARTITION_COL = "fetch_date"
ENTRY_COL = "entry"
# Entries of one source and date at which they are merged.
MERGE_ENTRIES = 16
_NO_DATE = "__HIVE_DEFAULT_PARTITION__"


def _date() -> Column:
    """The date of a row's folder, which has no type where no folder has a date."""
    return F.col(PARTITION_COL).cast("date").alias(PARTITION_COL)


def _date_folder(date: dt.date | None) -> str:
    return f"{PARTITION_COL}={_NO_DATE if date is None else date.isoformat()}"


def _date_folders(dates: Sequence[dt.date | None]) -> str:
    """A pattern for the folders of these dates."""
    return "{" + ",".join(sorted(_date_folder(d) for d in dates)) + "}"


def land_new_rows(batch: DataFrame, sink: str, source: str, batch_id: int, keys: Sequence[str] = ("id",),
                  event_time: str = "fetched_at", merge_entries: int = MERGE_ENTRIES) -> None:
    """Land the rows of ``batch`` whose ``keys`` were not landed before, however late they come.

    A row's date is that of ``event_time``; rows without a time have a folder of their own.
    Of rows with equal keys one is landed. Null keys equal each other.
    """
    spark, keys = batch.sparkSession, list(keys)
    fresh = batch.dropDuplicates(keys).withColumn(PARTITION_COL, F.to_date(event_time))
    # The dates of one batch, read from its own rows.
    dates = [r[0] for r in batch.select(F.to_date(event_time).alias("d")).distinct().collect()]
    known = known_keys(spark, sink, dates, (source, batch_id))
    if known is not None:
        same = fresh[PARTITION_COL].eqNullSafe(known[PARTITION_COL])
        for k in keys:
            same &= fresh[k].eqNullSafe(known[k])
        fresh = fresh.join(known, same, "left_anti")
    own = f"{_date_folders(dates)}/{SOURCE_COL}={source}"
    own_rows, own_keys = f"{sink}/rows/{own}/{BATCH_COL}={batch_id}", f"{sink}/keys/{own}/{ENTRY_COL}={_entry(batch_id)}"
    for place in [*matching(spark, own_rows), *matching(spark, own_keys)]:  # an earlier attempt of this batch
        delete(spark, place)
    # Dealt by date: else every task writes a file of every date.
    (fresh.withColumns({SOURCE_COL: F.lit(source), BATCH_COL: F.lit(batch_id)}).hint("rebalance", PARTITION_COL)
     .write.mode("append").partitionBy(PARTITION_COL, SOURCE_COL, BATCH_COL).parquet(f"{sink}/rows"))
    # The keys come last, from the rows as they were landed.
    landed = matching(spark, own_rows)
    if not landed:
        return
    (spark.read.option("basePath", f"{sink}/rows").parquet(*landed)
     .select(*keys, _date(), F.lit(source).alias(SOURCE_COL), F.lit(_entry(batch_id)).alias(ENTRY_COL))
     .write.mode("append").partitionBy(PARTITION_COL, SOURCE_COL, ENTRY_COL).parquet(f"{sink}/keys"))
    _merge_entries(spark, sink, own, source, batch_id, keys, merge_entries)


def _entry(batch_id: int, kind: str = "batch") -> str:
    return f"{batch_id:012d}-{kind}"


def known_keys(spark: SparkSession, sink: str, dates: Sequence[dt.date | None],
               without: tuple[str, int] | None = None) -> DataFrame | None:
    """Keys landed for the given dates, but for those of the batch named; None if there are none."""
    paths = matching(spark, f"{sink}/keys/{_date_folders(dates)}/{SOURCE_COL}=*")
    if not paths:
        return None
    found = spark.read.option("basePath", f"{sink}/keys").parquet(*paths)
    if without is not None:
        found = found.where((F.col(SOURCE_COL) != without[0]) | (F.col(ENTRY_COL) != _entry(without[1])))
    return found.withColumn(PARTITION_COL, _date()).drop(SOURCE_COL, ENTRY_COL)


def _merge_entries(spark: SparkSession, sink: str, own: str, source: str, batch_id: int, keys: Sequence[str], most: int) -> None:
    """Merge a source's entries of the dates that have many, but for the batch at hand, which may be
    retried; all these dates in one job.

    What the last merge took is deleted now: readers that began before that are done.
    """
    by_date = defaultdict(list)
    for path in matching(spark, f"{sink}/keys/{own}/{ENTRY_COL}=*"):
        place, entry = path.rsplit(f"/{ENTRY_COL}=", 1)
        by_date[place].append(entry)
    parts, done = [], []
    for place, entries in by_date.items():
        merged = sorted(e for e in entries if e.endswith("-merged"))
        last = merged[-1] if merged else ""
        open_ = [e for e in entries if last < e < _entry(batch_id) and e.endswith("-batch")]
        if len(open_) < most:
            continue
        parts += [f"{place}/{ENTRY_COL}={e}" for e in [*([last] if last else []), *open_]]
        done += [f"{place}/{ENTRY_COL}={e}" for e in entries if e < last]
    if not parts:
        return
    # Named for the first batch it doesn't hold, which sorts behind it.
    name = _entry(batch_id, "a-merged")
    (spark.read.option("basePath", f"{sink}/keys").parquet(*parts).select(*keys, _date()).distinct()
     .withColumns({SOURCE_COL: F.lit(source), ENTRY_COL: F.lit(name)}).hint("rebalance", PARTITION_COL)
     .sortWithinPartitions(PARTITION_COL, SOURCE_COL, ENTRY_COL, *keys)
     .write.mode("append").partitionBy(PARTITION_COL, SOURCE_COL, ENTRY_COL).parquet(f"{sink}/keys"))
    for path in done:
        delete(spark, path)


def read_rows(spark: SparkSession, sink: str) -> DataFrame:
    """Rows landed by ``land_new_rows``."""
    return spark.read.parquet(f"{sink}/rows").drop(SOURCE_COL, BATCH_COL, PARTITION_COL)
