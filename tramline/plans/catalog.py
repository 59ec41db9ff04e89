"""Named sources and model references (SRC-18).

A ``ModelCatalog`` maps source names to DataFrames and model names to
builders with their inputs. ``ref(name)`` builds a model from its inputs
(once per catalog); ``register_views`` exposes every model to
``spark.sql``; ``materialize`` writes a model to Parquet and re-points its
reference at the stored copy, so models read by several marts (staging
trip updates) are computed once per run and lineage is cut.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from tramline.operators.history import HistorySlices
from tramline.plans import marts, staging


@dataclass
class Model:
    build: Callable[..., DataFrame]
    inputs: list[str]
    params: dict = field(default_factory=dict)


def default_models(as_of=None, sparse_threshold: int = marts.SPARSE_HOUR_REPORTS, tz: str = staging.LOCAL_TZ,
                   split_keys: bool = False, approx: bool = False, history: HistorySlices | None = None) -> dict[str, Model]:
    """The nine models and what they read.

    ``split_keys`` spreads hot keys of the prediction history, ``approx`` takes sketches in the
    marts' medians and distinct counts, ``history`` has the prediction history by slices.
    """
    trip_updates = Model(staging.stg_trip_updates, ["raw_trip_updates", "gtfs_trips"], {"tz": tz, "split_keys": split_keys})
    if history is not None:
        trip_updates = Model(lambda trips, tz: staging.stg_trip_updates_from(history, trips, tz), ["gtfs_trips"], {"tz": tz})
    return {
        "stg_vehicle_positions": Model(staging.stg_vehicle_positions, ["raw_vehicle_positions"],
                                       {"tz": tz}),
        "stg_weather": Model(staging.stg_weather, ["raw_weather"], {"tz": tz}),
        "stg_trip_updates": trip_updates,
        "stg_alerts": Model(staging.stg_alerts, ["raw_alerts"], {"as_of": as_of, "tz": tz}),
        "stg_routes": Model(staging.stg_routes, ["gtfs_routes"]),
        "stg_stops": Model(staging.stg_stops, ["gtfs_stops"]),
        "fct_route_performance": Model(marts.fct_route_performance,
                                       ["stg_trip_updates", "stg_routes"], {"approx": approx}),
        "fct_hourly_service": Model(marts.fct_hourly_service,
                                    ["stg_vehicle_positions", "stg_trip_updates", "stg_weather"],
                                    {"sparse_threshold": sparse_threshold, "approx": approx}),
        "fct_alert_impact": Model(marts.fct_alert_impact, ["stg_alerts", "stg_routes"]),
    }


class ModelCatalog:
    def __init__(self, spark: SparkSession, sources: dict[str, DataFrame],
                 models: dict[str, Model] | None = None):
        self.spark = spark
        self.sources = dict(sources)
        self.models = models if models is not None else default_models()
        self._built: dict[str, DataFrame] = {}

    def source(self, name: str) -> DataFrame:
        return self.sources[name]

    def ref(self, name: str) -> DataFrame:
        if name in self._built:
            return self._built[name]
        if name in self.sources:
            return self.sources[name]
        model = self.models[name]
        df = model.build(*[self.ref(i) for i in model.inputs], **model.params)
        self._built[name] = df
        return df

    def register_views(self, names=None) -> list[str]:
        """Expose models (default: all) as temporary views for ``spark.sql``."""
        names = list(names or self.models)
        for n in names:
            self.ref(n).createOrReplaceTempView(n)
        return names

    def materialize(self, name: str, path: str) -> DataFrame:
        """Write a model once as Parquet and serve later refs from the copy."""
        self.ref(name).write.mode("overwrite").parquet(path)
        self._built[name] = self.spark.read.parquet(path)
        return self._built[name]


STAGING_MODELS = ["stg_vehicle_positions", "stg_weather", "stg_trip_updates", "stg_alerts",
                  "stg_routes", "stg_stops"]
# Models written at the same time; Spark shares its cores between their jobs.
MODEL_WORKERS = 4
MART_MODELS = ["fct_route_performance", "fct_hourly_service", "fct_alert_impact"]


def _store(catalog: ModelCatalog, name: str, path: str, metrics: dict | None) -> DataFrame:
    """Write one model and serve later refs from the copy; its row checks are observed meanwhile."""
    from tramline.operators.quality import SUITE, observe_checks

    df, obs = catalog.ref(name), None
    if metrics is not None:
        df, obs = observe_checks(df, name, [c for c in SUITE if c.model == name])
    df.write.mode("overwrite").parquet(path)
    if obs is not None:
        metrics[name] = obs.get
    catalog._built[name] = catalog.spark.read.schema(df.schema).parquet(path)
    return catalog._built[name]


def refresh(catalog: ModelCatalog, root: str, names=None, metrics: dict | None = None,
            workers: int = MODEL_WORKERS) -> dict[str, DataFrame]:
    """Build every model once, staging before marts, storing each as Parquet
    under ``root`` (the run step of DQ-4). Marts read the stored staging
    tables, so the trip-update history is computed once per run rather than
    once per consumer, and every stored table cuts lineage. Models that don't
    read each other are written at once, by ``workers`` threads.

    If ``metrics`` is a dict, the row-level checks of each model are observed
    while it is written and their failure counts are put in it.
    """
    left = list(names or STAGING_MODELS + MART_MODELS)
    out: dict[str, DataFrame] = {}
    with ThreadPoolExecutor(workers) as pool:
        while left:
            ready = [n for n in left if not set(catalog.models[n].inputs) & set(left)]
            for n in ready:
                catalog.ref(n)  # plans are made here; the threads only write
            out |= zip(ready, pool.map(lambda n: _store(catalog, n, f"{root}/{n}", metrics), ready), strict=True)
            left = [n for n in left if n not in ready]
    return out


def audit(catalog: ModelCatalog, root: str) -> DataFrame:
    """Build and store every model under ``root`` and check it: row-level checks while it is
    written, uniqueness on the stored tables. Returns the 39 rows ``(model, column_name,
    test, failures)``, stored beside the models."""
    from tramline.operators.quality import SUITE, run_suite

    metrics: dict = {}
    stored = refresh(catalog, root, metrics=metrics)
    observed = ", ".join(f"('{c.model}', '{c.column}', '{c.test}', {int(metrics[c.model][f'{c.column}.{c.test}'])}L)"
                         for c in SUITE if c.test != "unique")
    rows = catalog.spark.sql(f"SELECT * FROM VALUES {observed} AS t(model, column_name, test, failures)")
    results = rows.unionByName(run_suite(stored, tests=["unique"]))
    results.coalesce(1).write.mode("overwrite").parquet(f"{root}/_checks")
    return catalog.spark.read.schema(results.schema).parquet(f"{root}/_checks")


def run_models_and_tests(catalog: ModelCatalog, root: str, fail: bool = True) -> DataFrame:
    """The scheduled run (DQ-4): write, audit, publish.

    Every run has a folder ``version=<n>`` of its own under ``root``. Its models are stored and
    checked there, and only then is the version published: readers (``read_model``) see the
    tables of one passed run or of the next, and a failing run leaves them where they were.
    With ``fail`` any failing check raises, and nothing is published; without, the version
    is published as it is. Returns the result table.
    """
    from tramline.operators.quality import assert_passed
    from tramline.operators.sinks import publish

    version = time.time_ns() // 1_000_000
    results = audit(catalog, f"{root}/version={version}")
    if fail:
        assert_passed(results)
    publish(catalog.spark, root, version)
    return results


def read_model(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A model, or ``_checks``, of the newest published run."""
    from tramline.operators.sinks import published

    version = published(spark, root)
    if version is None:
        raise FileNotFoundError(f"no published run under {root}")
    return spark.read.parquet(f"{root}/version={version}/{name}")


def read_source(spark: SparkSession, path: str, fold: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """A raw table as its job stores it: a log of folds (``fold``), rows landed once
    (``flatten``), a published version (``refresh``) or a plain Parquet folder."""
    from tramline.operators import landing, sinks
    from tramline.operators.foldlog import FoldLog
    from tramline.operators.storage import folders

    names = {f.name for f in folders(spark, path)}
    if "log" in names or "base" in names:
        if fold is None:
            raise ValueError(f"{path} is a log of folds; say how it folds")
        return FoldLog(spark, path, fold).read()
    if "rows" in names:
        return landing.read_rows(spark, path)
    if "published" in names:
        return sinks.read_current(spark, path)
    return spark.read.parquet(path)
