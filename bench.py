"""Seconds per headline query, second run, over $BENCH_SF_DIR on local[$BENCH_CPUS]. Prints one JSON line.

BENCH_QUERIES names other queries (comma separated) or ``all``.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from quayside import workload
from quayside.session import build_session

HEADLINE = [
    "latest_snapshot_ties",
    "latest_snapshot_one",
    "snapshot_diff",
    "explode_lines",
    "expand_variants",
    "item_names",
    "country_lookup_or",
    "related_lookup",
    "propagate_filter_both",
    "merge_upsert",
    "merge_delete",
    "merge_latest_wins",
    "apply_changes",
    "mark_and_sweep",
    "date_dimension",
    "drill_month",
    "drill_rollup",
    "default_summaries",
    "kpi_by_segment",
    "kpi_growth_by_month",
    "kpi_growth_by_month_and_segment",
    "kpi_all_order_measures",
    "customers_repeat_new_by_segment",
    "customers_by_month",
    "pipeline_orders",
    "pipeline_products",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    workload.load_all()
    wanted = os.environ.get("BENCH_QUERIES")
    names = list(workload.QUERIES) if wanted == "all" else (wanted.split(",") if wanted else HEADLINE)
    spark = build_session("bench", cores)
    seconds: dict[str, float] = {}
    for name in [n for n in names if n in workload.QUERIES]:
        for _ in range(2):  # the first run warms up
            start = time.perf_counter()
            workload.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    total = round(sum(seconds.values()), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "total_query_seconds", "value": total, "unit": "sec", "queries": seconds, "sf": sf}))


if __name__ == "__main__":
    main()
