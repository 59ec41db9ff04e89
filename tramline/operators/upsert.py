"""Keyed fold of alert sightings and the one-off dedup backfill.

SRC-12 keyed upsert, SRC-13 outcome report, SRC-15 hash backfill,
SRC-16 collapse duplicates, JOIN-5 survivor update, JOIN-6 anti-join,
AGG-15 null-safe grouping key.

Parquet has no MERGE; an upsert is a fold: ``groupBy(key).agg(min, max, sum)``
over state and batch. min/max/sum are commutative and associative, so
folding batch A then B equals folding A and B together, and late or
reordered batches give the same state.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tramline.functions.text import content_hash
from tramline.schemas import ALERT_CONTENT

ENTITY_COLS = ("informed_route_id", "informed_stop_id", "informed_trip_id")
KEY_NAMES = ("alert_id", "content_hash", "_key_route", "_key_stop", "_key_trip")


def key_columns() -> list[Column]:
    """The conflict key; null entity parts compare as '' (G-17, AGG-15)."""
    return [
        F.col("alert_id"), F.col("content_hash"),
        *[F.coalesce(F.col(c), F.lit("")).alias(n) for c, n in zip(ENTITY_COLS, KEY_NAMES[2:])],
    ]


def with_key(df: DataFrame) -> DataFrame:
    return df.select("*", *key_columns()[2:])


def _payload_aggs() -> list[Column]:
    return [F.min(c).alias(c) for c in (*ALERT_CONTENT, *ENTITY_COLS)]


def fold_alerts(state: DataFrame | None, batch: DataFrame) -> DataFrame:
    """Fold a batch of alert rows into the state (SRC-12).

    Per key: the first sighting's id and fetch time, earliest first_seen_at,
    latest last_seen_at, summed times_seen (G-14: rows, not fetches). Content
    columns are constant per key because the fingerprint is in it; rows without one
    get it first, so that two alerts never fold into one for want of it. Rows
    without first/last/times (legacy) count as one sighting at fetched_at.
    """
    rows = batch if state is None else state.unionByName(batch, allowMissingColumns=True)
    return with_key(backfill_hashes(rows)).groupBy(*KEY_NAMES).agg(
        F.min("id").alias("id"),
        *_payload_aggs(),
        F.min(F.coalesce("first_seen_at", "fetched_at")).alias("first_seen_at"),
        F.max(F.coalesce("last_seen_at", "fetched_at")).alias("last_seen_at"),
        F.sum(F.coalesce(F.col("times_seen"), F.lit(1))).cast("int").alias("times_seen"),
        F.min("fetched_at").alias("fetched_at"),
    ).select(
        "id", "alert_id", "content_hash", *ALERT_CONTENT, *ENTITY_COLS,
        "first_seen_at", "last_seen_at", "times_seen", "fetched_at",
    )


def upsert_outcome(state: DataFrame, batch: DataFrame) -> DataFrame:
    """How many batch rows were inserted vs refreshed an existing key (SRC-13).

    Rows apply in order, so a key new to the state inserts once and every
    further row with it refreshes.
    """
    def marked(df: DataFrame, new: int) -> DataFrame:
        return with_key(backfill_hashes(df)).select(*KEY_NAMES, F.lit(new).alias("new"))

    # One aggregation over both sides with the fold's own key, in which nulls are equal.
    per_key = marked(state, 0).unionByName(marked(batch, 1)).groupBy(*KEY_NAMES).agg(
        F.sum("new").alias("rows_now"), F.min("new").alias("unseen"))
    inserted = F.count_if((F.col("unseen") == 1))
    return per_key.agg(
        inserted.alias("inserted"),
        (F.coalesce(F.sum("rows_now"), F.lit(0)) - inserted).cast("long").alias("refreshed"),
    )


def backfill_hashes(raw: DataFrame) -> DataFrame:
    """Fill missing fingerprints in one pass (SRC-15); existing ones stay."""
    return raw.withColumn(
        "content_hash", F.coalesce(F.col("content_hash"), content_hash(*ALERT_CONTENT)))


def collapse_duplicates(raw: DataFrame) -> DataFrame:
    """Keep the earliest row (smallest id) per key, annotated with the key's
    first/last fetch and its row count (SRC-16, G-18: the count replaces
    earlier counts). One aggregation, no self-join.
    """
    cols = [c for c in raw.columns if c not in ("first_seen_at", "last_seen_at", "times_seen")]
    return with_key(raw).groupBy(*KEY_NAMES).agg(
        F.min_by(F.struct(*cols), F.col("id")).alias("_keep"),
        F.min("fetched_at").alias("first_seen_at"),
        F.max("fetched_at").alias("last_seen_at"),
        F.count(F.lit(1)).cast("int").alias("times_seen"),
    ).select("_keep.*", "first_seen_at", "last_seen_at", "times_seen").select(*raw.columns)


SIGHTING_COLS = ("first_seen_at", "last_seen_at", "times_seen")


def survivor_update(raw: DataFrame) -> DataFrame:
    """The update-from-join step (JOIN-5): every row, with survivors (smallest
    id per key) annotated with the key's first/last fetch and row count."""
    notes = collapse_duplicates(raw).select(
        F.col("id").alias("_id"), F.struct(*SIGHTING_COLS).alias("_note"))
    noted = raw.join(notes, raw["id"] == notes["_id"], "left")
    return noted.select(*[
        F.when(F.col("_id").isNotNull(), F.col("_note")[c]).otherwise(F.col(c)).alias(c) if c in SIGHTING_COLS else F.col(c)
        for c in raw.columns])


def duplicate_rows(raw: DataFrame) -> DataFrame:
    """Rows the dedup deletes: those that aren't their key's survivor (JOIN-6, a left
    anti join on the id, which is never null)."""
    return raw.join(collapse_duplicates(raw).select("id"), on="id", how="left_anti")


def backfill(raw: DataFrame) -> DataFrame:
    """The one-off migration as one plan: fill the fingerprints, then collapse."""
    return collapse_duplicates(backfill_hashes(raw))
