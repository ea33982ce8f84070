"""Time the headline queries and print one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from dockflow.queries import QUERIES
from dockflow.session import local_session

HEADLINE = [
    "station_net_flow",
    "trip_stats",
    "trips_by_station",
    "hourly_od_summary",
    "od_counts",
    "route_pareto",
    "duration_describe",
    "network_summary",
    "supplier_net_flow",
    "supplier_od_pareto",
    "supplier_durations",
    "csv_roundtrip",
    "prepared_trips",
    "month_inventory",
    "supplier_month_inventory",
    "initial_inventory",
    "tracked_inventory",
    "fit_temporal_flow",
    "forecast_temporal_flow",
    "fold_metrics",
    "supplier_fold_metrics",
    "transition_probs",
    "net_flow_forecast",
    "forecast_markov",
    "forecast_ensemble",
    "lookback_sweep",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session("dockflow-bench", os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    chosen = sys.argv[1:] or HEADLINE
    # Start-up of the JVM and of the file readers is not a query.
    QUERIES["trips_by_hour"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for name in chosen:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        # No query profits from the tables another one kept.
        spark.catalog.clearCache()
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")),
            }
        )
    )


if __name__ == "__main__":
    main()
