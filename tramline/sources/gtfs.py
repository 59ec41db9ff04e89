"""Static timetable (GTFS) CSV loading (SRC-5..7, SRC-9, G-13).

Every column is text named by the file header; nothing is inferred.
Small files keep blank fields as '' and missing fields of short rows as null;
the large ``stop_times`` file follows bulk-load rules: an unquoted empty
field is null, a quoted empty field is ''. Files may be absent.
"""

from __future__ import annotations

import os

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# FIXED VALUES: timetable file -> table name.
SMALL_FILES = {
    "routes.txt": "gtfs_routes",
    "stops.txt": "gtfs_stops",
    "trips.txt": "gtfs_trips",
    "agency.txt": "gtfs_agency",
    "calendar.txt": "gtfs_calendar",
    "calendar_dates.txt": "gtfs_calendar_dates",
}
LARGE_FILES = {"stop_times.txt": "gtfs_stop_times"}

# A character that never occurs in the feed, so only unquoted blanks match it.
_NO_NULL = "\u0000"


_SHORT = "_short_row"


def _small_reader(spark: SparkSession):
    return (spark.read.option("header", True).option("multiLine", True).option("escape", '"')
            .option("encoding", "UTF-8").option("mode", "PERMISSIVE"))


def read_small_csv(spark: SparkSession, path: str) -> DataFrame:
    """Header-named text columns; quoted commas/newlines/doubled quotes handled; blank
    values read as '', fields that a short row lacks as null. multiLine keeps quoted
    newlines, at the cost of one split per file (these files are small)."""
    names = _small_reader(spark).option("inferSchema", False).csv(path).columns
    if not names:
        return spark.createDataFrame([], T.StructType([]))
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*names, _SHORT]])
    df = _small_reader(spark).schema(schema).option("columnNameOfCorruptRecord", _SHORT).option(
        "enforceSchema", True).csv(path)
    # A short row comes with its own text: its number of fields is that of the commas
    # outside quotes, plus one. A long row has enough fields for all columns.
    fields = F.size(F.split(_SHORT, ',(?=(?:[^"]*"[^"]*")*[^"]*$)', -1))
    return df.select(*[F.when(F.col(_SHORT).isNull() | (fields > i), F.coalesce(F.col(c), F.lit(""))).alias(c)
                       for i, c in enumerate(names)])


def read_bulk_csv(spark: SparkSession, path: str) -> DataFrame:
    """Large file: splittable line-oriented read; unquoted empty -> null,
    quoted empty -> '' (bulk-load semantics)."""
    return (spark.read.option("header", True).option("inferSchema", False)
            .option("multiLine", False).option("escape", '"').option("encoding", "UTF-8")
            .option("nullValue", _NO_NULL).option("emptyValue", "")
            .option("mode", "PERMISSIVE").csv(path))


def _try_read(reader, spark: SparkSession, path: str) -> DataFrame | None:
    try:
        df = reader(spark, path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None  # absent file
        raise
    if not df.columns:
        return None  # empty file: no header
    return df


def load_feed(spark: SparkSession, root: str, loaded_at=None) -> tuple[dict[str, DataFrame], list[str]]:
    """Read every known timetable file present under ``root``.

    Returns ``(tables, skipped)``: table name -> DataFrame stamped with
    ``loaded_at``, and the file names that were absent or had no header.
    """
    stamp = F.current_timestamp().cast("timestamp_ntz") if loaded_at is None else \
        F.lit(loaded_at).cast("timestamp_ntz")
    tables: dict[str, DataFrame] = {}
    skipped: list[str] = []
    for files, reader in ((SMALL_FILES, read_small_csv), (LARGE_FILES, read_bulk_csv)):
        for fname, tname in files.items():
            df = _try_read(reader, spark, os.path.join(root, fname))
            if df is None:
                skipped.append(fname)
            else:
                tables[tname] = df.withColumn("loaded_at", stamp)
    return tables, skipped


def write_csv(df: DataFrame, path: str) -> None:
    """Write a table as a header CSV; blanks are quoted so they read back as ''."""
    (df.write.mode("overwrite").option("header", True).option("escape", '"')
       .option("quoteAll", False).csv(path))


def refresh_feed(spark: SparkSession, root: str, store: str, loaded_at=None) -> list[str]:
    """The timetable load as a job (SRC-5..7, SRC-9): every file present under ``root``
    becomes a new published version of its table under ``store``. Returns the skipped files."""
    from tramline.operators.sinks import full_refresh

    tables, skipped = load_feed(spark, root, loaded_at)
    for name, df in tables.items():
        full_refresh(df.drop("loaded_at"), f"{store}/{name}", loaded_at)
    return skipped


def stored_feed(spark: SparkSession, store: str) -> dict[str, DataFrame]:
    """The current tables of a stored timetable."""
    from tramline.operators.sinks import published, read_current

    names = [*SMALL_FILES.values(), *LARGE_FILES.values()]
    return {n: read_current(spark, f"{store}/{n}") for n in names if published(spark, f"{store}/{n}") is not None}
