"""Headline queries timed at one scale; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) set data and cores. Each
query runs once to warm up and BENCH_RUNS times (default 3) for the median; every row is computed
(noop sink). The value is the sum of the medians.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

from terrace.queries import QUERIES
from terrace.session import build_session

HEADLINE = [
    "revenue_by_region", "secured_revenue", "expect_drop", "dedupe_latest", "current_state", "history",
    "diff_snapshots", "gold_rollup", "refresh_aggregate", "write_partitioned", "reconcile_sources", "hierarchy_rollup",
    "binding_violations", "catalog_report", "change_feed", "row_filter", "column_mask", "effective_privileges",
    "rotate_keys", "scan_sensitive", "redact_text", "network_violations", "match_identities", "config_drift", "sessionize",
    "detect_bursts", "distribution", "verify_access", "anomalies", "price_usage", "attribute_cost", "allocate_shared",
    "budget_burn", "join_interval", "dedupe_stream",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{"spark.checkpoint.dir": tempfile.mkdtemp(prefix="bench-"), "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "16g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}
    for name in names:
        times = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:]), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {"metric": "headline_total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": sf}
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
