"""Structured Streaming jobs over landed snapshot files (STR-1..6).

The reference polls feeds on a timer; each poll is a micro-batch here. Jobs
read snapshot files as they land, keep state in the checkpoint, and write
through idempotent sinks, so a restarted or retried batch never counts twice.

* STR-1 ``flatten_stream``: nested snapshots -> landed rows (append).
* STR-2 ``alert_folds``: running keyed fold of alert sightings.
* STR-3 ``latest_weather``: latest fetch per observation time.
* STR-4 ``hourly_fleet``: per-hour vehicle activity.
* STR-5 ``enrich_stream``: stream-static join with the trip table.
* STR-6 ``append_new_rows``: re-delivered snapshot rows are landed once.

Nothing is dropped for being late; a watermark only says which hours are final. Running state (STR-2/3/4) is a ``FoldLog``: each
micro-batch is folded by itself into a folder named by its checkpoint's query and its
number, which a retried batch overwrites, and readers fold the partial results; since the folds may be applied
in any order, late, re-ordered and re-started deliveries end in the same state.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tramline.functions.time import hour_bucket
from tramline.operators import landing
from tramline.operators.foldlog import FoldLog, alert_fold_table
from tramline.operators.sinks import published, read_keyed
from tramline.operators.storage import BATCH_COL, SOURCE_COL, query_source
from tramline.operators.windows import keep_latest


# How far event time may trail before an hour is final (STR-4).
FINAL_AFTER = "2 hours"


def file_stream(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet",
                files_per_batch: int = 10_000) -> DataFrame:
    """Snapshot files landing under ``path`` as a stream (schema fixed, no inference); a
    backlog is worked off in micro-batches of ``files_per_batch`` files."""
    return spark.readStream.schema(schema).format(fmt).option("maxFilesPerTrigger", files_per_batch).load(path)


def _run(writer, checkpoint: str, available_now: bool, processing_time: str | None,
         state_partitions: int | None = None):
    """Start a query. ``state_partitions`` fixes the number of state-store
    partitions of stateful operators; it is read when the query first starts
    and kept in the checkpoint thereafter (default: the session's shuffle
    partitions)."""
    writer = writer.option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    spark = SparkSession.getActiveSession() or SparkSession.builder.getOrCreate()
    old = spark.conf.get("spark.sql.shuffle.partitions") if state_partitions else None
    try:
        if state_partitions:
            spark.conf.set("spark.sql.shuffle.partitions", str(state_partitions))
        q = writer.start()
    finally:
        if old is not None:
            spark.conf.set("spark.sql.shuffle.partitions", old)
    if available_now:
        q.awaitTermination()
    return q


def append_to_files(stream: DataFrame, sink: str, checkpoint: str, partition_by=None,
                    available_now: bool = True, processing_time: str | None = None,
                    state_partitions: int | None = None):
    """Exactly-once file sink: the sink log makes replayed batches invisible."""
    w = stream.writeStream.format("parquet").outputMode("append").option("path", sink)
    if partition_by:
        w = w.partitionBy(*partition_by)
    return _run(w, checkpoint, available_now, processing_time, state_partitions)


def fold_batches(stream: DataFrame, log: FoldLog, checkpoint: str, available_now: bool = True,
                 processing_time: str | None = None, compact_every: int | None = None):
    """Fold each micro-batch into ``log``, under the name of the checkpoint's query; when
    ``compact_every`` batches lie beside the base they are folded into a new one, and what
    older bases held is expired."""

    def write(batch: DataFrame, batch_id: int) -> None:
        log.append(batch, batch_id, query_source(batch.sparkSession))
        if compact_every and len(log.batches()) >= compact_every:
            log.compact()
            log.expire()

    return _run(stream.writeStream.foreachBatch(write), checkpoint, available_now, processing_time)


# --- STR-1 / STR-6 ------------------------------------------------------------------
def flatten_stream(snapshots: DataFrame, flatten: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """STR-1: apply a batch flattener to a stream of nested snapshots."""
    return flatten(snapshots)


def append_new_rows(stream: DataFrame, sink: str, checkpoint: str, keys: Sequence[str] = ("id",),
                    event_time: str = "fetched_at", available_now: bool = True, processing_time: str | None = None,
                    merge_entries: int = landing.MERGE_ENTRIES):
    """STR-6: land rows whose ``keys`` were not landed before, however late they come.

    Snapshot row ids are deterministic, so a re-delivered snapshot repeats its keys. See
    ``operators.landing``: a micro-batch reads the keys of its own dates, and is named by its
    query's checkpoint, so that a new checkpoint on the same folder lands nothing twice
    and overwrites nothing.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        landing.land_new_rows(batch, sink, query_source(batch.sparkSession), batch_id, keys, event_time, merge_entries)

    return _run(stream.writeStream.foreachBatch(write), checkpoint, available_now, processing_time)


read_rows = landing.read_rows


# --- STR-2 ----------------------------------------------------------------------
def alert_folds(spark: SparkSession, path: str) -> FoldLog:
    """STR-2: alert sightings folded per conflict key."""
    return alert_fold_table(spark, path)


# --- STR-3 ----------------------------------------------------------------------
def latest_weather(spark: SparkSession, path: str) -> FoldLog:
    """STR-3: the newest fetch per observation time (ties to the larger id)."""
    return FoldLog(spark, path, lambda rows: keep_latest(rows, ["observed_at"], ["fetched_at", "id"]))


# --- STR-4 ----------------------------------------------------------------------
def hourly_fleet(spark: SparkSession, path: str) -> FoldLog:
    """STR-4: reports per (UTC hour, vehicle).

    Exact distinct counts don't add up over batches, so the state is kept at
    (hour, vehicle) grain and ``read_hourly_fleet`` counts vehicles per hour from it.
    Hours are UTC: at the autumn DST change the local-hour mart merges two
    UTC hours, this job keeps them apart (G-6).
    """
    def fold(rows: DataFrame) -> DataFrame:
        if "reports" not in rows.columns:
            rows = rows.where((F.col("latitude") != 0) & (F.col("longitude") != 0)).select(
                hour_bucket("fetched_at").alias("hour_utc"), "vehicle_id", F.lit(1).cast("long").alias("reports"))
        return rows.groupBy("hour_utc", "vehicle_id").agg(F.sum("reports").alias("reports"))

    return FoldLog(spark, path, fold)


def final_hours(positions: DataFrame, delay: str = FINAL_AFTER) -> DataFrame:
    """STR-4: reports per (hour, vehicle) of hours that are over, by event-time windows.

    The watermark trails the newest report by ``delay``; an hour behind it is emitted once and
    leaves the state, which so holds the open hours only. Reports that come
    later are not in here: ``read_hourly_fleet`` counts them.
    """
    valid = positions.where((F.col("latitude") != 0) & (F.col("longitude") != 0)).select(
        F.col("fetched_at").cast("timestamp").alias("at"), "vehicle_id")
    hours = valid.withWatermark("at", delay).groupBy(F.window("at", "1 hour").alias("w"), "vehicle_id").agg(
        F.count(F.lit(1)).alias("reports"))
    return hours.select(F.col("w.start").cast("timestamp_ntz").alias("hour_utc"), "vehicle_id", "reports")


def hour_closings(spark: SparkSession, path: str) -> FoldLog:
    """What ``final_hours`` emitted. A query with a new checkpoint closes its hours again; the
    greater count stays."""
    return FoldLog(spark, path, lambda rows: rows.groupBy("hour_utc", "vehicle_id").agg(F.max("reports").alias("reports")))


def close_hours(positions: DataFrame, closings: FoldLog, checkpoint: str, delay: str = FINAL_AFTER,
                available_now: bool = True, processing_time: str | None = None, state_partitions: int | None = None):
    """Run ``final_hours`` into ``closings``; each micro-batch is a batch of the log."""
    def write(batch: DataFrame, batch_id: int) -> None:
        closings.append(batch, batch_id, query_source(batch.sparkSession))

    return _run(final_hours(positions, delay).writeStream.outputMode("append").foreachBatch(write), checkpoint,
                available_now, processing_time, state_partitions)


def read_hourly_fleet(log: FoldLog, closings: FoldLog | None = None) -> DataFrame:
    """Active vehicles and reports per hour, late ones included.

    With ``closings`` also is_final (the watermark has passed the hour) and late_reports, the
    corrections: reports that came when their hour was final.
    """
    hours = log.read().groupBy("hour_utc").agg(
        F.count(F.lit(1)).alias("active_vehicles"), F.sum("reports").alias("position_reports"))
    if closings is None:
        return hours
    if closings.partials() is None:
        return hours.withColumns({"is_final": F.lit(False), "late_reports": F.lit(0).cast("long")})
    closed = closings.read().groupBy("hour_utc").agg(F.sum("reports").alias("in_time"))
    # A watermark behind one hour is behind all hours before it.
    final = F.coalesce(F.col("hour_utc") <= closed.select(F.max("hour_utc")).scalar(), F.lit(False))
    late = F.when(F.col("is_final"), F.col("position_reports") - F.coalesce("in_time", F.lit(0))).otherwise(0)
    return (hours.join(closed, "hour_utc", "left").withColumn("is_final", final)
            .withColumn("late_reports", late.cast("long")).drop("in_time"))


def sketched_fleet(spark: SparkSession, path: str, lg_config: int = 12) -> FoldLog:
    """STR-4 with approximate distincts: one row per hour, a mergeable sketch of its vehicles.

    The state doesn't grow with the number of vehicles. The relative standard error of the
    count is 1.04 / sqrt(2 ** lg_config), 1.6 % by default; reports are exact.
    """
    def fold(rows: DataFrame) -> DataFrame:
        if "vehicles" in rows.columns:
            return rows.groupBy("hour_utc").agg(
                F.hll_union_agg("vehicles").alias("vehicles"), F.sum("reports").alias("reports"))
        valid = rows.where((F.col("latitude") != 0) & (F.col("longitude") != 0))
        return valid.groupBy(hour_bucket("fetched_at").alias("hour_utc")).agg(
            F.hll_sketch_agg("vehicle_id", F.lit(lg_config)).alias("vehicles"), F.count(F.lit(1)).alias("reports"))

    return FoldLog(spark, path, fold)


def read_sketched_fleet(log: FoldLog) -> DataFrame:
    return log.read().select("hour_utc", F.hll_sketch_estimate("vehicles").alias("active_vehicles"),
                             F.col("reports").alias("position_reports"))


# --- STR-5 ----------------------------------------------------------------------
def enrich_stream(trip_updates: DataFrame, trips: DataFrame) -> DataFrame:
    """STR-5: left join of predictions to the trip table."""
    return trip_updates.drop("route_id").join(trips.select("trip_id", "route_id", "direction_id",
                                          "trip_headsign"), "trip_id", "left")


class PublishedTable:
    """The newest published version of a keyed table, for joins with micro-batches.

    A version stored by ``sinks.publish_keyed`` is bucketed by its key, so a join deals
    only the micro-batch, and a version whose files are under the session's broadcast
    bound is broadcast. It is loaded, and kept in executors' memory, until another is published.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.version: int | None = None
        self.table: DataFrame | None = None

    def current(self) -> DataFrame:
        version = published(self.spark, self.path)
        if version is None:
            raise FileNotFoundError(f"no published version under {self.path}")
        if version != self.version or self.table is None:
            if self.table is not None:
                self.table.unpersist()
            self.version, self.table = version, read_keyed(self.spark, self.path, version).persist()
        return self.table


def enrich_batches(trip_updates: DataFrame, trips: PublishedTable, sink: str, checkpoint: str,
                   available_now: bool = True, processing_time: str | None = None):
    """STR-5: each micro-batch joined to the trip table's version of its time, written under
    the batch's own name, which a retry overwrites."""
    def write(batch: DataFrame, batch_id: int) -> None:
        source = query_source(batch.sparkSession)
        enrich_stream(batch, trips.current()).write.mode("overwrite").parquet(
            f"{sink}/{SOURCE_COL}={source}/{BATCH_COL}={batch_id}")

    return _run(trip_updates.writeStream.foreachBatch(write), checkpoint, available_now, processing_time)
