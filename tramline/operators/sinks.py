"""Landing sinks and table maintenance (SRC-8..11, SRC-14, SRC-17).

Paths are shared storage (the session's checkpoint folder in tests). Writes
are whole Spark jobs: tasks that die are retried, and a write only becomes
visible at job commit.
"""

from __future__ import annotations

import datetime as _dt
import hashlib
import json
import time
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tramline.operators.foldlog import FoldLog, alert_fold_table
from tramline.operators.upsert import KEY_NAMES

PARTITION_COL = "fetch_date"


def read_if_present(spark: SparkSession, path: str) -> DataFrame | None:
    """A Parquet folder, or None if there is none. Any other failure is raised."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def publish(spark: SparkSession, path: str, version: int) -> None:
    """Name ``version`` as complete: one row appended to ``path/published``."""
    spark.range(1).select(F.lit(version).cast("long").alias("version")).coalesce(1).write.mode("append").parquet(
        f"{path}/published")


def published(spark: SparkSession, path: str) -> int | None:
    """The newest version that was published under ``path``."""
    pointer = read_if_present(spark, f"{path}/published")
    return None if pointer is None else pointer.agg(F.max("version")).first()[0]


def append_snapshot(df: DataFrame, path: str, partition_col: str = PARTITION_COL) -> None:
    """Append one snapshot batch, partitioned by fetch date (SRC-8).

    Rows are dealt by date with a rebalance, which adaptive execution sizes: a small
    batch leaves a file per date, and a date of any size is split over many tasks.
    """
    spark = df.sparkSession
    record_schema(spark, path, df.schema)
    (df.withColumn(partition_col, F.to_date("fetched_at")).hint("rebalance", partition_col)
       .write.mode("append").partitionBy(partition_col).parquet(path))


def read_landed(spark: SparkSession, path: str, since=None, until=None) -> DataFrame:
    """Read an appended table. Its record has the columns of all batches, so no footer is
    read to find them, and a column that only some files have is null in the others
    (SRC-10). Without a record (files of another job) every footer is read.

    ``since`` / ``until`` (inclusive dates) filter the ``fetch_date`` partition
    column, so only those date folders are listed and scanned (partition
    pruning) — e.g. a job over the last days of a multi-year table.
    """
    known = recorded_schema(spark, path)
    if known is None:
        df = spark.read.option("mergeSchema", "true").parquet(path)
    else:
        df = spark.read.schema(T.StructType([*known, T.StructField(PARTITION_COL, T.DateType())])).parquet(path)
    if since is not None:
        df = df.where(F.col(PARTITION_COL) >= F.lit(since).cast("date"))
    if until is not None:
        df = df.where(F.col(PARTITION_COL) <= F.lit(until).cast("date"))
    return df


def evolve(df: DataFrame, defaults: dict | None = None) -> DataFrame:
    """Fill added columns on old rows with their declared default (SRC-10)."""
    for col, value in (defaults or {}).items():
        df = df.withColumn(col, F.coalesce(F.col(col), F.lit(value)))
    return df


def union_evolving(old: DataFrame, new: DataFrame, defaults: dict | None = None) -> DataFrame:
    """Union frames of different vintages by name, adding missing columns (SRC-10)."""
    return evolve(old.unionByName(new, allowMissingColumns=True), defaults)


def full_refresh(df: DataFrame, path: str, loaded_at=None, version: int | None = None) -> int:
    """Replace a reference table (SRC-9).

    Each load writes its own folder ``version=<n>``, stamped with ``loaded_at``, and is
    published when complete; readers go by the published version, so they never see
    an empty, half-written or doubled table. A retried load overwrites its own folder.
    Returns the version written.
    """
    if version is None:
        version = int(_dt.datetime.now(_dt.timezone.utc).timestamp() * 1000)
    stamp = F.current_timestamp().cast("timestamp_ntz") if loaded_at is None else \
        F.lit(loaded_at).cast("timestamp_ntz")
    df.withColumn("loaded_at", stamp).write.mode("overwrite").parquet(f"{path}/version={version}")
    publish(df.sparkSession, path, version)
    return version


def read_current(spark: SparkSession, path: str) -> DataFrame:
    """The newest published version of a fully refreshed table; only its folder is read."""
    version = published(spark, path)
    if version is None:
        raise FileNotFoundError(f"no published version under {path}")
    return spark.read.parquet(f"{path}/version={version}")


def publish_keyed(df: DataFrame, path: str, key: str, version: int, buckets: int | None = None) -> int:
    """Store and publish a version of a keyed table, bucketed and sorted by ``key``: joins on the
    key need not deal it again. See ``read_keyed``. A retried load overwrites its own folder."""
    spark = df.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    folder, name = f"{path}/version={version}", f"tramline_load_{uuid.uuid4().hex}"
    (df.repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key).sortBy(key)
     .option("path", folder).saveAsTable(name))
    spark.sql(f"DROP TABLE {name}")  # the folder stays
    spark.range(1).select(F.lit(key).alias("key"), F.lit(buckets).alias("buckets")).coalesce(1).write.mode("overwrite").parquet(
        f"{path}/layout/version={version}")
    publish(spark, path, version)
    return version


def read_keyed(spark: SparkSession, path: str, version: int) -> DataFrame:
    """A version stored by ``publish_keyed``, whose bucketing the session gets to know."""
    layout = spark.read.parquet(f"{path}/layout/version={version}").first()
    folder = f"{path}/version={version}"
    name = f"tramline_keyed_{hashlib.sha256(folder.encode()).hexdigest()[:24]}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(folder).schema)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet CLUSTERED BY (`{layout['key']}`) "
              f"SORTED BY (`{layout['key']}`) INTO {layout['buckets']} BUCKETS LOCATION '{folder}'")
    return spark.table(name)


def record_schema(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """Add a landed table's columns to its record (SRC-10), if it doesn't have them yet: one
    small file per change, beside the rows."""
    known = recorded_schema(spark, path)
    new = [f for f in schema if known is None or f.name not in known.names]
    if new:
        merged = T.StructType([*(known or T.StructType()), *(T.StructField(f.name, f.dataType) for f in new)])
        spark.range(1).select(F.lit(time.time_ns()).alias("at"), F.lit(merged.json()).alias("schema")).coalesce(1).write.mode(
            "append").parquet(f"{path}/_schema")


def recorded_schema(spark: SparkSession, path: str) -> T.StructType | None:
    """The columns of all batches of a landed table, from its record; two batches that added
    columns at the same time are both in it."""
    record = read_if_present(spark, f"{path}/_schema")
    if record is None:
        return None
    fields: dict[str, T.StructField] = {}
    for row in record.orderBy("at").collect():  # one row per change of the layout
        for f in T.StructType.fromJson(json.loads(row["schema"])):
            fields.setdefault(f.name, f)
    return T.StructType(list(fields.values()))


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table: (table_name, row_count) (SRC-14, SET-1)."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count"))
             .select(F.lit(name).alias("table_name"), "row_count")
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def write_keyed_layout(df: DataFrame, table_name: str, path: str, key: str,
                       buckets: int | None = None) -> DataFrame:
    """Store a table bucketed and sorted by ``key`` (SRC-17): joins of two
    tables bucketed alike on the key need no shuffle, and sorted files let
    key filters skip row groups. ``buckets`` defaults to the session's shuffle
    partitions, which follow the size of the data (``session.size_for_input``).
    Returns the table as read back."""
    buckets = buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (df.repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key).sortBy(key)
       .option("path", path).saveAsTable(table_name))
    return df.sparkSession.table(table_name)


__all__ = [
    "FoldLog", "KEY_NAMES", "alert_fold_table", "append_snapshot", "evolve", "full_refresh", "publish", "publish_keyed", "published",
    "read_current", "read_if_present", "read_keyed", "read_landed", "record_schema", "recorded_schema", "row_counts",
    "union_evolving", "write_keyed_layout",
]
