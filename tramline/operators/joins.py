"""Fact-to-dimension joins (JOIN-1, JOIN-2).

A dimension is broadcast where its bytes are bounded: at planning if the statistics of its
files keep it under ``spark.sql.autoBroadcastJoinThreshold`` (8 MB in this library's
sessions), else by adaptive execution once the side's own stage has run and its bytes
are measured against ``spark.sql.adaptive.autoBroadcastJoinThreshold`` (32 MB). A dimension
beyond both stays a shuffle join, in which skewed keys are split. Planning starts no job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def join_dimension(fact: DataFrame, dim: DataFrame, on, how: str = "inner") -> DataFrame:
    """Join a fact to a dimension; the physical join follows the measured size."""
    return fact.join(dim, on=on, how=how)
