"""Declarative data-quality checks (DQ-1..4).

``not_null`` and ``accepted_values`` checks of one model are evaluated in a
single aggregation pass (one ``count_if`` per check); each ``unique`` check
is one grouped aggregation. The result is a small table
``(model, column_name, test, failures)``; nothing is collected.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Check:
    model: str
    column: str
    test: str  # not_null | unique | accepted_values
    values: tuple = ()


def _checks(model: str, spec: list[tuple]) -> list[Check]:
    out = []
    for column, *tests in spec:
        for t in tests:
            if isinstance(t, tuple):
                out.append(Check(model, column, "accepted_values", tuple(t)))
            else:
                out.append(Check(model, column, t))
    return out


# FIXED VALUES: the checks declared on the nine models (39 in all).
HOURS = tuple(range(24))
ROUTE_MODES = ("tram", "metro", "rail", "bus", "ferry", "cable_tram", "aerial_lift", "funicular",
               "other")
ENTITY_TYPES = ("route", "stop", "trip", "unknown")
SUITE: list[Check] = [
    *_checks("stg_vehicle_positions", [
        ("id", "unique", "not_null"), ("vehicle_id", "not_null"), ("latitude", "not_null"),
        ("longitude", "not_null")]),
    *_checks("stg_weather", [("observed_at", "unique", "not_null"), ("temperature_c", "not_null")]),
    *_checks("stg_trip_updates", [
        ("trip_id", "not_null"), ("route_id", "not_null"), ("stop_sequence", "not_null"),
        ("is_latest_observation", "not_null"), ("observation_number", "not_null")]),
    *_checks("stg_alerts", [
        ("alert_id", "not_null"), ("entity_type", "not_null", ENTITY_TYPES),
        ("effect", "not_null")]),
    *_checks("stg_routes", [
        ("route_id", "unique", "not_null"), ("route_short_name", "not_null"),
        ("route_mode", ROUTE_MODES)]),
    *_checks("stg_stops", [
        ("stop_id", "unique", "not_null"), ("stop_name", "not_null"), ("latitude", "not_null"),
        ("longitude", "not_null")]),
    *_checks("fct_route_performance", [
        ("route_id", "unique", "not_null"), ("route_short_name", "not_null"),
        ("observations", "not_null"), ("median_delay_seconds", "not_null")]),
    *_checks("fct_hourly_service", [
        ("hour_bucket", "unique", "not_null"), ("active_vehicles", "not_null"),
        ("local_hour", "not_null", HOURS)]),
    *_checks("fct_alert_impact", [
        ("route_id", "not_null"), ("alert_id", "not_null"), ("effect", "not_null")]),
]


def not_null_failures(df: DataFrame, column: str) -> DataFrame:
    """Failing rows of ``not_null`` (DQ-1)."""
    return df.where(F.col(column).isNull())


def unique_failures(df: DataFrame, column: str) -> DataFrame:
    """Values occurring more than once, nulls ignored (DQ-2)."""
    return (df.where(F.col(column).isNotNull()).groupBy(column)
            .agg(F.count(F.lit(1)).alias("n_records")).where(F.col("n_records") > 1))


def accepted_values_failures(df: DataFrame, column: str, values: Iterable) -> DataFrame:
    """Rows whose value is outside the list; null passes (DQ-3)."""
    return df.where(~F.col(column).isin(list(values)))


def _row_checks(df: DataFrame, checks: list[Check]) -> DataFrame | None:
    aggs = []
    for i, c in enumerate(checks):
        if c.test == "not_null":
            failing = F.col(c.column).isNull()
        else:
            failing = ~F.col(c.column).isin(list(c.values))
        aggs.append(F.count_if(failing).alias(f"c{i}"))
    if not aggs:
        return None
    wide = df.agg(*aggs)
    stack = ", ".join(f"'{c.model}', '{c.column}', '{c.test}', c{i}" for i, c in enumerate(checks))
    return wide.selectExpr(
        f"stack({len(checks)}, {stack}) AS (model, column_name, test, failures)")


def union_all(parts: list[DataFrame]) -> DataFrame:
    """Union same-shaped frames as a balanced tree (cheaper to analyse than a chain)."""
    while len(parts) > 1:
        parts = [parts[i].unionByName(parts[i + 1]) if i + 1 < len(parts) else parts[i]
                 for i in range(0, len(parts), 2)]
    return parts[0]


def run_checks(df: DataFrame, checks: list[Check]) -> DataFrame:
    """Evaluate the checks of one model; one row per check."""
    parts = []
    row = _row_checks(df, [c for c in checks if c.test != "unique"])
    if row is not None:
        parts.append(row)
    for c in checks:
        if c.test == "unique":
            parts.append(unique_failures(df, c.column).agg(F.count(F.lit(1)).alias("failures"))
                         .select(F.lit(c.model).alias("model"), F.lit(c.column).alias("column_name"),
                                 F.lit("unique").alias("test"), "failures"))
    return union_all(parts)


def run_suite(models: dict[str, DataFrame], checks: list[Check] = SUITE,
              tests: Iterable[str] | None = None) -> DataFrame:
    """Run the declared checks over the given models (DQ-4).

    ``failures`` is the number of failing rows (unique: duplicated values).
    A run passes when every row has ``failures = 0``; see ``assert_passed``.
    """
    wanted = set(tests) if tests else None
    parts = []
    for model, df in models.items():
        mine = [c for c in checks if c.model == model and (wanted is None or c.test in wanted)]
        if mine:
            parts.append(run_checks(df, mine))
    return union_all(parts)


def assert_passed(results: DataFrame) -> None:
    """Fail the run if any check failed (the suite gate of DQ-4)."""
    failed = results.where(F.col("failures") > 0).select("model", "column_name", "test",
                                                         "failures").take(50)
    if failed:
        raise AssertionError("data-quality checks failed: " + "; ".join(
            f"{r.model}.{r.column_name} {r.test}: {r.failures}" for r in failed))


def unique_combination_failures(df: DataFrame, columns: list[str]) -> DataFrame:
    """Combinations of ``columns`` occurring more than once (a grain check,
    e.g. one row per (route, alert) in the impact mart, G-19)."""
    return (df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n_records"))
            .where(F.col("n_records") > 1))


def observe_checks(df: DataFrame, name: str, checks: list[Check]):
    """Attach the row-level checks (not_null, accepted_values) of one model as
    an ``Observation``: they are computed while the model is written or
    consumed, with no separate scan. Returns ``(df, observation)``; after an
    action ``observation.get`` maps ``<column>.<test>`` to failing rows."""
    from pyspark.sql import Observation

    obs = Observation(name)
    metrics = []
    for c in checks:
        if c.test == "not_null":
            failing = F.col(c.column).isNull()
        elif c.test == "accepted_values":
            failing = ~F.col(c.column).isin(list(c.values))
        else:
            continue
        metrics.append(F.count_if(failing).alias(f"{c.column}.{c.test}"))
    if not metrics:
        return df, None
    return df.observe(obs, *metrics), obs
