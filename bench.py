"""Benchmark the headline queries.

Runs each named query on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]``: one warm-up, then the median of ``$BENCH_RUNS``
(default 3) timed runs. A run executes the whole plan and discards the
rows (noop sink), so the driver never holds the result. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from adlens.plans.catalog import QUERIES  # noqa: E402
from adlens.session import build_session  # noqa: E402

HEADLINE = [
    "conversion_fact", "reconciliation", "exec_summary", "conversion_insights",
    "incremental_roas", "campaign_drilldown", "adset_drilldown", "brand_mapping",
    "brand_spend", "demand_generation_long", "coverage_grid", "guardrails", "mapping_audit",
    "ask_top_campaigns_combined", "ask_total_spend_combined",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(f"local[{cpus}]", shuffle_partitions=max(int(cpus), 1),
                          extra={"spark.ui.showConsoleProgress": "false",
                                 "spark.driver.memory": "16g"})
    out = {}
    for n in names:
        def run():
            t = time.perf_counter()
            QUERIES[n](spark, sf_dir).write.format("noop").mode("overwrite").save()
            return time.perf_counter() - t
        run()
        out[n] = round(statistics.median(run() for _ in range(runs)), 3)
    sf = sf_dir.rstrip("/").rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(out.values()), 3),
                      "unit": "sec", "queries": out, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
