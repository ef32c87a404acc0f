"""Benchmark the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query's full plan is executed into the ``noop`` sink (no collect to the driver); prints
one JSON line with per-query seconds and their sum.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from stockroom.plans import catalog  # noqa: E402
from stockroom.session import build_session  # noqa: E402

HEADLINE = [
    "daily_delta",
    "daily_delta_lineitem",
    "event_type_breakdown_lineitem",
    "running_balance_lineitem",
    "replay_state_lineitem",
    "daily_features",
    "oversell_apply",
    "ingest_results",
    "cascade_apply",
    "forecast_7d",
    "fleet_status",
    "dq_report",
    "export_manifest",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        f"local[{cpus}]",
        app_name="stockroom-bench",
        shuffle_partitions=cpus * 2,
        extra={"spark.driver.memory": "16g"},
    )
    # Intermediate tables go to the session's spark.checkpoint.dir; a private one only if unset.
    if not spark.sparkContext.getConf().get("spark.checkpoint.dir", None):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="stockroom-bench-"))
    # Steady-state timings: one untimed pass on the smallest tables warms the JVM (JIT,
    # codegen caches) and the Python workers used by the pandas-backed operators.
    warm_dir = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    for name in names:
        catalog.QUERIES[name](spark, warm_dir).write.format("noop").mode("overwrite").save()
    timings: dict[str, float] = {}
    for name in names:
        t0 = time.perf_counter()
        catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - t0, 3)
    spark.stop()
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
            }
        )
    )


if __name__ == "__main__":
    main()
