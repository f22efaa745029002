"""Time the headline queries and print one JSON line.

Every query is computed in full into Spark's no-op sink. One small untimed query warms the JVM up.
BENCH_SF_DIR names the test data, BENCH_CPUS the local cores, BENCH_QUERIES a list to run instead.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from barloom.checks.queries import REGISTRY  # noqa: E402
from barloom.session import local_session  # noqa: E402

HEADLINE = [
    "best_performer", "range_return", "most_volatile", "close_stats", "price_trend",
    "run_history", "unresolved_issues", "run_summary_all", "run_gate", "run_log_state",
    "enriched_bars", "enrich_history_scope", "typed_fact", "recompute_metrics",
    "verdicts", "clean_bars", "issues", "quality_summary",
    "watermarks", "incremental_filter", "empty_extracts",
    "idempotent_load", "load_counts", "dim_upsert", "bars_source", "daily_run",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES", "").split() or HEADLINE
    spark = local_session(cpus, "bench")

    def run(name: str) -> float:
        began = time.perf_counter()
        REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - began, 3)

    run("close_stats")
    seconds = {name: run(name) for name in chosen}
    spark.stop()
    print(json.dumps({"metric": "headline queries, total time", "value": round(sum(seconds.values()), 3),
                      "unit": "sec", "queries": seconds, "sf": os.path.basename(sf_dir).removeprefix("sf"),
                      "cpus": cpus}))


if __name__ == "__main__":
    main()
