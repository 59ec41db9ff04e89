"""Oracle SQL per registered query key (see ``tramline.oracle``)."""

from __future__ import annotations

from tramline import oracle as o

ORACLE: dict[str, str] = {}

for _name in ("stg_vehicle_positions", "stg_weather", "stg_trip_updates", "stg_alerts",
              "stg_routes", "stg_stops"):
    ORACLE[_name] = o.model_sql(_name)

ORACLE["route_performance"] = o.with_ctes(o.MARTS["route_performance"],
                                          ["stg_trip_updates", "stg_routes"])
ORACLE["hourly_service"] = o.with_ctes(o.MARTS["hourly_service"],
                                       ["stg_vehicle_positions", "stg_trip_updates", "stg_weather"])
ORACLE["alert_impact"] = o.with_ctes(o.MARTS["alert_impact"], ["stg_alerts", "stg_routes"])

for _name in o.EXTRA:
    if _name in o.EXTRA_DEPS:
        ORACLE[_name] = o.extra_sql(_name)
ORACLE["named_models"] = o.named_models_sql()

for _test in ("not_null", "unique", "accepted_values"):
    ORACLE[f"dq_{_test}"] = o.suite_sql(_test)
ORACLE["dq_suite"] = o.suite_sql()
ORACLE["sparse_hours"] = o.with_model_ctes(o.SPARSE_SQL, ["fct_hourly_service"])

ORACLE["dq_alert_grain"] = o.grain_sql()
ORACLE["alert_unmatched_routes"] = o.with_ctes(o.EXTRA["alert_unmatched_routes"],
                                               ["stg_alerts", "stg_routes"])

for _name in ("backfill_job", "fn_time_parts", "win_event_history", "win_event_history_split", "agg_event_stats", "fn_codes"):
    ORACLE[_name] = o.extra_sql(_name)
ORACLE["trip_history_slices"] = o.model_sql("stg_trip_updates")
