"""Keyed history windows and keep-latest (WIN-1..6).

All windows are partitioned by a key: there is never an unpartitioned window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tramline.session import scratch_dir


def _asc(cols: Sequence[str]) -> list[Column]:
    # Ascending with nulls last, as the reference database orders (G-4).
    return [F.col(c).asc_nulls_last() for c in cols]


def _history_window(df, keys, order, value, prefix):
    w = Window.partitionBy(*keys).orderBy(*_asc(order))
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # one select: every expression shares the window's single exchange and sort
    return df.select(
        "*",
        F.row_number().over(w).alias(f"{prefix}observation_number"),
        F.count(F.lit(1)).over(whole).alias(f"{prefix}total_observations"),
        F.lag(value).over(w).alias(f"{prefix}previous_value"),
        F.first(value, ignorenulls=False).over(whole).alias(f"{prefix}first_value"),
    )


def _ranged_history(df, keys, order, value, prefix, ranges):
    """The same metrics with every key's rows cut at the borders of global ranges.

    1. rows are dealt to ``ranges`` partitions by range of (keys, order), so a key of any
       size spans as many partitions as its share of the rows, also when its rows
       agree in all but the last order column; the dealt rows are stored in the
       shared checkpoint folder, as the borders are drawn from a sample and both
       readers below must see the same ones;
    2. the window runs per (key, range);
    3. a row per (key, range), aggregated from the window's output without another
       exchange, gives counts, first and last values; a window over these adds up what
       lies in front of each range;
    4. rows meet their range's offsets on (key, range), as they are already dealt.

    The key is one struct, in which nulls equal each other as they do in a window.
    """
    key, rng = "_history_key", "_history_range"
    path = scratch_dir(df.sparkSession, "history-ranges")
    (df.repartitionByRange(ranges, *_asc([*keys, *order])).withColumn(rng, F.spark_partition_id())
     .write.mode("overwrite").parquet(path))
    cut = df.sparkSession.read.parquet(path).withColumn(key, F.struct(*keys))
    w = Window.partitionBy(key, rng).orderBy(*_asc(order))
    local = cut.select("*", F.row_number().over(w).alias("_local_n"), F.lag(value).over(w).alias("_local_prev"))
    at_first = F.when(F.col("_local_n") == 1, F.struct(F.col(value).alias("v")))
    parts = local.groupBy(key, rng).agg(
        F.count(F.lit(1)).alias("_cnt"), F.max(at_first).alias("_first"),
        F.max_by(F.struct(F.col(value).alias("v")), "_local_n").alias("_last"))
    kw = Window.partitionBy(key).orderBy(rng)
    whole = kw.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = parts.select(
        key, rng,
        F.coalesce(F.sum("_cnt").over(kw.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_offset"),
        F.lag("_last").over(kw).alias("_before"),
        F.first("_first").over(whole).alias("_key_first"),
        F.sum("_cnt").over(whole).alias("_key_total"))
    return local.join(offsets, [key, rng]).select(
        *df.columns,
        (F.col("_local_n") + F.col("_offset")).cast("int").alias(f"{prefix}observation_number"),
        F.col("_key_total").alias(f"{prefix}total_observations"),
        F.when(F.col("_local_n") == 1, F.col("_before.v")).otherwise(F.col("_local_prev"))
        .alias(f"{prefix}previous_value"),
        F.col("_key_first.v").alias(f"{prefix}first_value"))


def observation_history(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    prefix: str = "",
    split: bool = False,
    ranges: int | None = None,
) -> DataFrame:
    """Add per-key observation metrics over a total order (WIN-1..5).

    * ``observation_number``: 1, 2, ... ascending (row_number);
    * ``total_observations``: rows in the key (count over the whole partition);
    * ``recency_rank``: 1 for the newest row. Computed as total - number + 1,
      which equals a descending row_number when ``order`` is total (G-3), and
      saves a second sort;
    * ``previous_value`` via lag and ``first_value`` via first_value over the
      whole frame, both keeping nulls.

    One exchange on ``keys`` and one sort serve every expression, and a key's rows
    meet in one task. ``split=True`` is for tables whose keys may hold a large share of
    the rows: every key is cut at the borders of ``ranges`` global ranges (the
    session's shuffle partitions by default) at the cost of one more exchange and a
    stored copy of the rows, which is written when the plan is built. The result is
    the same for any data: null keys, any orderable type, equal order values.
    """
    keys, order = list(keys), list(order)
    if split:
        ranges = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        out = _ranged_history(df, keys, order, value, prefix, ranges)
    else:
        out = _history_window(df, keys, order, value, prefix)
    return out.withColumn(
        f"{prefix}recency_rank",
        F.col(f"{prefix}total_observations") - F.col(f"{prefix}observation_number") + F.lit(1),
    )


def keep_latest(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    method: str = "aggregate",
) -> DataFrame:
    """Keep the newest row per key (WIN-6): ``row_number() over (partition by
    keys order by order desc) = 1``, nulls in the order columns ranked first
    as the reference does for descending order (G-4).

    ``method='aggregate'`` (default) folds with ``max_by`` under a partial
    aggregation: no sort, and a key holding a large share of the rows is
    reduced to one row per map task before the shuffle.
    ``method='window'`` is the row_number form; Catalyst adds a
    WindowGroupLimit on both sides of the exchange.
    """
    cols = df.columns
    if method == "window":
        w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_first() for c in order])
        return (
            df.withColumn("_rn", F.row_number().over(w))
            .where(F.col("_rn") == 1)
            .drop("_rn")
        )
    # Rank key: (order col is null, order col) per column; max picks nulls first,
    # then the greatest value.
    rank_parts = []
    for c in order:
        rank_parts += [F.col(c).isNull(), F.col(c)]
    rank = F.struct(*rank_parts)
    payload = F.struct(*[F.col(c) for c in cols if c not in keys])
    agg = df.groupBy(*keys).agg(F.max_by(payload, rank).alias("_latest"))
    return agg.select(*[F.col(k) for k in keys], "_latest.*").select(*cols)
