"""Benchmark: the end-to-end run and headline queries at one scale factor.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Prints one JSON line. ``value`` is the end-to-end pipeline time (load,
forest forecast, KMeans classes + packs + finance with revision rounds,
265 s for the reference. Per-step and per-query seconds are in ``queries``.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from packflow.session import get_spark
    spark = get_spark(f"local[{cpus}]", shuffle_partitions=int(cpus) * 2, driver_memory="16g",
                      app="packflow-bench")
    from packflow.plans.catalog import REGISTRY
    from packflow.plans.pipeline import run_pipeline
    from packflow.sources import binding as B

    q = {}
    t0 = time.time()
    B.master_table(spark, sf_dir)
    q["build_master"] = round(time.time() - t0, 3)

    t0 = time.time()
    steps: dict = {}
    res = run_pipeline(spark, sf_dir, timings=steps)
    res["benchmark_comparison"].collect()
    total = time.time() - t0
    q.update({f"pipeline_{k}": v for k, v in steps.items()})

    for name in ("plant_statistics", "production_schedule", "financial_table", "dispatch_plan",
                 "shortest_paths", "build_features", "describe_panel", "correlation_matrix",
                 "top_skus_by_sales"):
        t1 = time.time()
        REGISTRY[name].fn(spark, sf_dir).collect()
        q[name] = round(time.time() - t1, 3)

    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "end_to_end_pipeline", "value": round(total + q["build_master"], 3),
                      "unit": "sec", "queries": q, "sf": sf, "cpus": int(cpus)}))
    spark.stop()


if __name__ == "__main__":
    main()
