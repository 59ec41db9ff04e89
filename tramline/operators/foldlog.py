"""Keyed state as a log of partial folds (SRC-12, STR-2..4)."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline.operators.storage import BATCH_COL, SOURCE_COL, delete, folders, is_complete, older_than
from tramline.operators.upsert import fold_alerts

Batch = tuple[str, int]


@dataclass
class Pointer:
    """The published base: its folder, and for each source the last batch it holds."""

    version: int = 0
    base: str | None = None
    upto: dict[str, int] = field(default_factory=dict)

    def holds(self, batch: Batch) -> bool:
        return batch[1] <= self.upto.get(batch[0], -1)


class FoldLog:
    """State per key as partial folds.

    ``fold`` maps rows, or rows it made before, to one row per key and may be
    applied in any order and again to its own output. Each batch is folded by itself
    and written to ``log/source=<s>/batch_id=<n>``; a batch that is retried overwrites its own
    folder, so nothing counts twice and no state is read or rewritten. A batch's name
    is its source and its number (see ``storage``): batches of different queries, of a
    reset checkpoint or of other files never meet in one folder. Numbers of one source grow.

    Reading folds what the log holds. ``compact`` folds the committed batches into a new base
    and publishes its name together with the batches in it, in one row; these are
    then read from there. ``expire`` deletes what a published base has held for a while.
    """

    def __init__(self, spark: SparkSession, path: str, fold: Callable[[DataFrame], DataFrame]):
        self.spark, self.path, self.fold = spark, path, fold

    def pointer(self) -> Pointer:
        newest = [f.name for f in folders(self.spark, f"{self.path}/published")
                  if is_complete(self.spark, f"{self.path}/published/{f.name}")][-1:]
        if not newest:
            return Pointer()
        row = self.spark.read.parquet(f"{self.path}/published/{newest[0]}").first()
        return Pointer(row["version"], row["base"], dict(row["upto"]))

    def append(self, batch: DataFrame, batch_id: int, source: str = "batch") -> bool:
        """Fold and add a batch; False if the base holds it (the retry of a finished batch)."""
        return self.append_folded(self.fold(batch), batch_id, source)

    def append_folded(self, folded: DataFrame, batch_id: int, source: str = "batch") -> bool:
        if self.pointer().holds((source, batch_id)):
            return False
        folded.write.mode("overwrite").parquet(self._folder((source, batch_id)))
        return True

    def _folder(self, batch: Batch) -> str:
        return f"{self.path}/log/{SOURCE_COL}={batch[0]}/{BATCH_COL}={batch[1]}"

    def batches(self, pointer: Pointer | None = None) -> list[Batch]:
        """The committed batches that the base doesn't hold."""
        pointer = pointer or self.pointer()
        found = []
        for s in folders(self.spark, f"{self.path}/log"):
            source = s.name.removeprefix(f"{SOURCE_COL}=")
            for b in folders(self.spark, f"{self.path}/log/{s.name}"):
                batch = source, int(b.name.removeprefix(f"{BATCH_COL}="))
                if not pointer.holds(batch) and is_complete(self.spark, self._folder(batch)):
                    found.append(batch)
        return sorted(found)

    def partials(self, without: Batch | None = None) -> DataFrame | None:
        """The base and the batches that it doesn't hold, but for the one named; None if there is nothing."""
        pointer = self.pointer()
        return self._partials(pointer, [b for b in self.batches(pointer) if b != without])

    def _partials(self, pointer: Pointer, batches: list[Batch]) -> DataFrame | None:
        parts = [self.spark.read.parquet(f"{self.path}/base/{pointer.base}")] if pointer.base else []
        if batches:
            parts.append(self.spark.read.parquet(*[self._folder(b) for b in batches]))
        if not parts:
            return None
        return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])

    def read(self, without: Batch | None = None) -> DataFrame:
        partials = self.partials(without)
        if partials is None:
            raise FileNotFoundError(f"no batch under {self.path}")
        return self.fold(partials)

    def compact(self) -> None:
        """Fold the base and all committed batches into a new base and publish it."""
        pointer = self.pointer()
        batches = self.batches(pointer)
        if not batches:
            return
        upto = dict(pointer.upto)
        for source, n in batches:
            upto[source] = max(n, upto.get(source, -1))
        name = f"{pointer.version + 1:012d}-{uuid.uuid4().hex[:8]}"
        self.fold(self._partials(pointer, batches)).write.parquet(f"{self.path}/base/{name}")
        row = self.spark.range(1).select(
            F.lit(pointer.version + 1).cast("long").alias("version"), F.lit(name).alias("base"),
            F.create_map(*[F.lit(x) for s, n in upto.items() for x in (s, n)]).cast("map<string,bigint>").alias("upto"))
        row.coalesce(1).write.parquet(f"{self.path}/published/{name}")

    def expire(self, grace_seconds: float = 86_400) -> None:
        """Delete batches that the base holds, and older bases and pointers, once they are older
        than ``grace_seconds``: readers that began before must be done by then."""
        pointer = self.pointer()
        for s in folders(self.spark, f"{self.path}/log"):
            for b in folders(self.spark, f"{self.path}/log/{s.name}"):
                batch = s.name.removeprefix(f"{SOURCE_COL}="), int(b.name.removeprefix(f"{BATCH_COL}="))
                if pointer.holds(batch) and older_than(b, grace_seconds):
                    delete(self.spark, self._folder(batch))
        for kind in ("published", "base"):
            for f in folders(self.spark, f"{self.path}/{kind}"):
                if pointer.base and f.name < pointer.base and older_than(f, grace_seconds):
                    delete(self.spark, f"{self.path}/{kind}/{f.name}")


def alert_fold_table(spark: SparkSession, path: str) -> FoldLog:
    """Alert sightings folded per conflict key (SRC-12)."""
    return FoldLog(spark, path, lambda rows: fold_alerts(None, rows))
