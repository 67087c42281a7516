"""Benchmark: run the headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS].

Each query is executed in full with the ``noop`` sink (every row computed, nothing collected)
and timed; one JSON line is printed:
{"metric": "total_query_seconds", "value": N, "unit": "sec", "queries": {...}, "sf": ...}
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

HEADLINE = [
    "inspection_label",          # flagship: infractions → labelled inspections
    "inspections_aggregate",     # two-level aggregate with pivot
    "history_features",          # stage 7 in one windowed pass
    "point_in_polygon",          # spatial join
    "crime_fill_by_year",        # full stage 4 chain (coordinates, areas, census, crimes)
    "ml_features",               # model-ready table (stages 2-7 end to end)
    "profile_table",             # one-pass column profile
    "weekday_error_share",       # evaluation aggregate
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from kitchenlens.plans.catalog import QUERIES
    from kitchenlens.session import get_session

    spark = get_session(f"local[{cpus}]", app="kitchenlens-bench", shuffle_partitions=int(cpus) * 2,
                        conf={"spark.driver.memory": "16g"})
    names = [n for n in HEADLINE if n in QUERIES]
    # warm-up: JVM class loading, code generation and parquet footers, not timed
    for warm in ("normalise_infractions", "inspection_label"):
        QUERIES[warm](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else sf_dir
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
