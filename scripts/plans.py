"""Print the formatted physical plan of registered queries.

Usage: python scripts/plans.py [--sf DIR] [query ...]   (default: the nine models, sf0.001)
Shows exchanges, broadcasts, pushed filters and read schemas as Catalyst plans them.
"""

from __future__ import annotations

import argparse
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tramline.plans.queries import REGISTRY  # noqa: E402
from tramline.session import build_session  # noqa: E402

MODELS = ["stg_vehicle_positions", "stg_weather", "stg_trip_updates", "stg_alerts", "stg_routes",
          "stg_stops", "route_performance", "hourly_service", "alert_impact"]


def main() -> None:
    p = argparse.ArgumentParser()
    p.add_argument("--sf", default="/root/testdata/sf0.001")
    p.add_argument("names", nargs="*")
    args = p.parse_args()
    spark = build_session(master="local[4]")
    for name in args.names or MODELS:
        print(f"===== {name}")
        REGISTRY[name](spark, args.sf).explain(mode="formatted")


if __name__ == "__main__":
    main()
