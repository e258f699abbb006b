"""Time the headline queries; print one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Each query runs to completion through the ``noop`` sink (all rows are
computed, nothing is collected to the driver)."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from fleetlens.registry import QUERIES  # noqa: E402
from fleetlens.session import build_session, drop_intermediate  # noqa: E402

HEADLINE = [
    "silver_segments",
    "trip_summary",
    "route_hourly_emissions",
    "bus_daily_emissions",
    "kpi_summary",
    "top_buses",
    "top_routes",
    "trip_outliers",
    "route_emission_days",
    "trip_paths",
    "stream_silver",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=cpus, app_name="fleetlens-bench")
    # Warm-up: JVM, Python workers and file listing.
    QUERIES["bus_daily_emissions"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in HEADLINE:
        if name not in QUERIES:
            continue
        t0 = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
        spark.catalog.clearCache()
        drop_intermediate(spark)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": sf,
                "cpus": cpus,
                "spark": spark.version,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
