"""Rounding and ratio helpers (G-7).

Three rules are in play:
* averages/stddev of integers and percentages: half away from zero;
* interpolated percentiles (float8 in the reference): half to even;
* doubles averaged then rounded as numeric: go through a decimal first.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def round_half_away(col, scale: int = 0) -> Column:
    """Half away from zero, as DOUBLE."""
    return F.round(_c(col), scale).cast("double")


def round_half_even(col) -> Column:
    """Half to even to a whole number, as DOUBLE (for percentiles).

    Adding 0.0 turns a negative zero into zero, as numeric rounding gives.
    """
    return F.rint(_c(col)) + F.lit(0.0)


def round_numeric(col, scale: int = 1) -> Column:
    """Round a double as the reference rounds ``x::numeric``: decimal first."""
    return F.round(_c(col).cast("decimal(28,12)"), scale).cast("double")


def pct(part, whole, scale: int = 1) -> Column:
    """``round(100.0 * part / nullif(whole, 0), scale)`` computed in decimal (exact)."""
    whole_ = F.nullif(_c(whole).cast("decimal(20,0)"), F.lit(0).cast("decimal(20,0)"))
    return F.round(F.lit(100).cast("decimal(4,1)") * _c(part) / whole_, scale).cast("double")
