"""Folders of the shared storage: listing and deleting them through Spark's file systems,
and the identity of a batch.

A batch is named by its source and a number. The source of a micro-batch is the id that its
query keeps in its checkpoint, so a new checkpoint, or a second query, never takes the name of
an earlier batch, and a retried micro-batch always has its old one. The source of a batch read
from files is a digest of their names.
"""

from __future__ import annotations

import hashlib
import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

SOURCE_COL = "source"
BATCH_COL = "batch_id"


def _file_system(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


@dataclass(frozen=True)
class Folder:
    name: str
    modified: float


def folders(spark: SparkSession, path: str) -> list[Folder]:
    """The folders right below ``path``, by name; none if there is no such path."""
    fs, where = _file_system(spark, path)
    if not fs.exists(where):
        return []
    found = [Folder(s.getPath().getName(), s.getModificationTime() / 1000) for s in fs.listStatus(where) if s.isDirectory()]
    return sorted(found, key=lambda f: f.name)


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """The paths that fit a pattern (``*``, ``{a,b}``), in order."""
    fs, where = _file_system(spark, pattern)
    found = fs.globStatus(where)
    return [] if found is None else [p.toString() for p in spark._jvm.org.apache.hadoop.fs.FileUtil.stat2Paths(found)]


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether the job that wrote the folder was committed."""
    fs, _ = _file_system(spark, path)
    return fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS"))


def delete(spark: SparkSession, path: str) -> None:
    fs, where = _file_system(spark, path)
    fs.delete(where, True)


def query_source(spark: SparkSession) -> str:
    """The source of the micro-batch at hand; to be called within ``foreachBatch``."""
    query = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
    if not query:
        raise RuntimeError("no streaming query runs here")
    return f"query-{query}"


def file_source(batch: DataFrame) -> str:
    """The source of a batch that was read from files: the same files give the same name."""
    names = sorted(batch.inputFiles())
    return f"files-{hashlib.sha256(chr(10).join(names).encode()).hexdigest()[:32]}"


def older_than(folder: Folder, seconds: float) -> bool:
    return time.time() - folder.modified >= seconds


__all__ = ["BATCH_COL", "SOURCE_COL", "Folder", "delete", "file_source", "folders", "is_complete", "matching", "older_than", "query_source"]
