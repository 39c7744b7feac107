"""Time the headline queries and print one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from marketlens.plans.catalog import QUERIES
from marketlens.session import build_session

HEADLINE = (
    "lifecycle_current_state", "lifecycle_events", "lifecycle_run_summary", "price_summary",
    "bounded_price_history", "archive_deletion_plan", "deletion_ledger", "canonical_records",
    "canonical_reconciliation", "page_state_rows", "structured_page_rows", "route_before_parsing",
    "market_context", "year_groups", "duplicate_candidates", "duplicate_index", "closest_other_source",
    "configuration_claims", "investigation_classes", "subject_comparability", "preference_matching",
    "manual_review", "anomalies", "page_diagnostics", "text_rule_claims", "index_faults",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES", "").split(",") if os.environ.get("BENCH_QUERIES") else HEADLINE
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()
    times: dict[str, float] = {}
    for name in names:
        start = time.time()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - start, 3)
        if os.environ.get("BENCH_VERBOSE"):
            print(name, times[name], file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
