"""Benchmark: headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS].

Each query is executed in full with the ``noop`` sink (no driver collect).
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "season_summary", "dispatch_standardize", "zone_from_dispatch", "clock_report", "clock_fixed_dispatches",
    "point_in_zone", "raster_fuel", "dem_sample", "weather_features", "feature_table", "train_test_split",
    "groupwise_mapping", "base_model", "residual_intervals", "residual_diagnostics",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    from brasa.session import get_spark
    from brasa.plans.queries import SPARK
    spark = get_spark(f"local[{cpus}]", **{"spark.sql.shuffle.partitions": str(int(cpus) * 2),
                                            "spark.driver.memory": os.environ.get("BENCH_MEM", "16g")})
    spark.sparkContext.setLogLevel("ERROR")
    SPARK["season_summary"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
    times = {}
    for n in names:
        ts = []
        for _ in range(runs):
            t0 = time.perf_counter()
            SPARK[n](spark, sf_dir).write.format("noop").mode("overwrite").save()
            ts.append(time.perf_counter() - t0)
        times[n] = round(statistics.median(ts), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_headline_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
                      "cpus": int(cpus), "runs": runs}))
    spark.stop()


if __name__ == "__main__":
    main()
