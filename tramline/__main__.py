"""Command line: the scheduled jobs as Spark applications.

  python -m tramline run --raw DIR --gtfs DIR|--store DIR --out DIR [--as-of TS] [--tz ZONE]
                         [--split-keys] [--approx] [--history DIR --dates D,D..] [--no-fail]
      read the timetable (CSVs, or the stored tables) and the raw tables, build and store
      all models as a new version under --out, run the 39 checks and publish the version
      (on any failure nothing is published, unless --no-fail). With --history the prediction
      history is kept there by date, and only --dates are windowed
  python -m tramline flatten --kind positions|trip_updates|alerts|weather --src DIR --dst DIR
      flatten landed nested snapshots (Parquet, weather: JSON) and land the rows that
      weren't landed before; the same files again land nothing
  python -m tramline fold --batch DIR --state DIR [--compact] [--expire-days N]
      upsert a batch of alert rows into the alert fold table and print how many were new; the
      batch is known by its files, so the same files again count once
  python -m tramline refresh --gtfs DIR --store DIR
      load the timetable CSVs as a new published version of each stored table
  python -m tramline backfill --src DIR --dst DIR
      fill missing fingerprints of landed alerts and collapse duplicates, once

Raw tables are folders named raw_vehicle_positions, raw_trip_updates, raw_alerts and
raw_weather under --raw: Parquet, what flatten lands, or (alerts) what fold keeps.
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys

from tramline.session import build_session

RAW_TABLES = ("raw_vehicle_positions", "raw_trip_updates", "raw_alerts", "raw_weather")


def _run(args, spark) -> int:
    from tramline.operators.upsert import fold_alerts
    from tramline.plans import staging
    from tramline.plans.catalog import ModelCatalog, default_models, read_source, run_models_and_tests
    from tramline.sources.gtfs import load_feed, stored_feed

    tables, skipped = (stored_feed(spark, args.store), []) if args.store else load_feed(spark, args.gtfs)
    folds = {"raw_alerts": lambda rows: fold_alerts(None, rows)}
    sources = {t: read_source(spark, f"{args.raw}/{t}", folds.get(t)) for t in RAW_TABLES}
    sources.update(tables)
    history = None
    if args.history:
        history = staging.trip_history(spark, args.history, args.split_keys)
        dated = spark.read.parquet(_rows_of(spark, f"{args.raw}/raw_trip_updates"))
        history.update(staging.trip_observations(dated), [None if d == "none" else dt.date.fromisoformat(d) for d in args.dates])
    models = default_models(as_of=args.as_of, tz=args.tz or staging.LOCAL_TZ, split_keys=args.split_keys,
                            approx=args.approx, history=history)
    run_models_and_tests(ModelCatalog(spark, sources, models), args.out, fail=not args.no_fail)
    if skipped:
        print("timetable files absent:", ", ".join(skipped))
    return 0


def _rows_of(spark, path: str) -> str:
    """Where a table's rows lie by fetch date."""
    from tramline.operators.storage import folders

    return f"{path}/rows" if any(f.name == "rows" for f in folders(spark, path)) else path


def _flatten(args, spark) -> int:
    from tramline import schemas
    from tramline.operators.landing import land_new_rows
    from tramline.operators.storage import file_source
    from tramline.sources import feeds

    if args.kind == "weather":
        read = feeds.read_weather_json(spark, args.src)
        flat = feeds.flatten_weather(read)
    else:
        schema, fn = {
            "positions": (schemas.VEHICLE_FEED, feeds.flatten_vehicle_positions),
            "trip_updates": (schemas.TRIP_FEED, feeds.flatten_trip_updates),
            "alerts": (schemas.ALERT_FEED, feeds.flatten_alerts),
        }[args.kind]
        read = spark.read.schema(schema).parquet(args.src)
        flat = fn(read)
    land_new_rows(flat, args.dst, file_source(read), 0)
    return 0


def _fold(args, spark) -> int:
    from tramline.operators.foldlog import alert_fold_table
    from tramline.operators.storage import file_source
    from tramline.operators.upsert import upsert_outcome
    from tramline.plans.catalog import read_source

    table = alert_fold_table(spark, args.state)
    batch = read_source(spark, args.batch)
    name = file_source(batch), 0
    before = table.partials(without=name)
    if table.append(batch, name[1], name[0]):
        state = table.fold(before if before is not None else batch.limit(0))
        out = upsert_outcome(state, batch).first()
        print(f"alerts inserted: {out['inserted']}, refreshed: {out['refreshed']}")
    else:
        print("these files are in the table already")
    if args.compact:
        table.compact()
    if args.expire_days is not None:
        table.expire(args.expire_days * 86_400)
    return 0


def _refresh(args, spark) -> int:
    from tramline.sources.gtfs import refresh_feed

    if skipped := refresh_feed(spark, args.gtfs, args.store):
        print("timetable files absent:", ", ".join(skipped))
    return 0


def _backfill(args, spark) -> int:
    from tramline.operators.upsert import backfill

    backfill(spark.read.parquet(args.src)).write.mode("errorifexists").parquet(args.dst)
    return 0


def parse(argv=None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="tramline")
    sub = p.add_subparsers(dest="cmd", required=True)
    r = sub.add_parser("run")
    r.add_argument("--raw", required=True)
    where = r.add_mutually_exclusive_group(required=True)
    where.add_argument("--gtfs")
    where.add_argument("--store")
    r.add_argument("--out", required=True)
    r.add_argument("--as-of", default=None)
    r.add_argument("--tz", default=None)
    r.add_argument("--split-keys", action="store_true")
    r.add_argument("--approx", action="store_true")
    r.add_argument("--history", default=None)
    r.add_argument("--dates", type=lambda x: x.split(","), default=[])
    r.add_argument("--no-fail", action="store_true")
    f = sub.add_parser("flatten")
    f.add_argument("--kind", required=True, choices=["positions", "trip_updates", "alerts", "weather"])
    f.add_argument("--src", required=True)
    f.add_argument("--dst", required=True)
    u = sub.add_parser("fold")
    u.add_argument("--batch", required=True)
    u.add_argument("--state", required=True)
    u.add_argument("--compact", action="store_true")
    u.add_argument("--expire-days", type=float, default=None)
    g = sub.add_parser("refresh")
    g.add_argument("--gtfs", required=True)
    g.add_argument("--store", required=True)
    b = sub.add_parser("backfill")
    b.add_argument("--src", required=True)
    b.add_argument("--dst", required=True)
    return p.parse_args(argv)


def main(argv=None) -> int:
    args = parse(argv)
    spark = build_session(master=None, app_name=f"tramline-{args.cmd}")
    commands = {"run": _run, "flatten": _flatten, "fold": _fold, "refresh": _refresh, "backfill": _backfill}
    return commands[args.cmd](args, spark)


if __name__ == "__main__":
    sys.exit(main())
