"""Bench: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is fully evaluated with the ``noop`` sink (no driver transfer)
and timed; prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from riskframe.plans.queries import QUERIES  # noqa: E402
from riskframe.session import build_session  # noqa: E402

HEADLINE = [
    "quality_report", "validate_records", "derived_columns", "exact_stratified_split",
    "stratified_folds", "correlation", "histogram", "classification_report", "subgroup_audit",
    "drift_report", "daily_psi", "run_ranking", "metric_alerts", "rolling_retrain",
    "feature_stats", "csv_contract_scan", "stream_sliding_confusion", "model_scoring",
    "cv_tuning",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=max(8, 2 * cpus),
                          driver_memory=os.environ.get("BENCH_DRIVER_MEMORY", "16g"))
    # untimed warm-up: JVM start-up and code generation are not any query's cost
    spark.read.parquet(f"{sf_dir.rstrip('/')}/lineitem.parquet").groupBy("l_returnflag").count() \
        .write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for name in names:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
