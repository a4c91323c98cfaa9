"""Headline queries, timed one by one.

Prints one JSON line.  BENCH_SF_DIR names the tables, BENCH_CPUS the local cores.  Each query is built and run in
full (every row and column is produced) into a sink that discards it, after two warm-up queries for the JVM.
"""

from __future__ import annotations

import json
import os
import time

from panelyard.session import build_session
from panelyard.workload import QUERIES

# Every family once or more; all queries are in __spark_entry__.queries().
HEADLINE = [
    "flagship", "merge_last", "merge_coalesce", "merge_policy", "preserve_measure", "replace_subset", "feed_dedup",
    "latest_by", "session_counts", "year_summary", "last_seen", "change_ratio", "rank_in_market", "rank_ties",
    "coverage_continuity", "write_coverage", "shrink_guard", "price_drift", "verify_reference", "mass_change",
    "closed_copy", "rebase_safe", "settle_plan", "settle_apply", "reconcile", "cursor", "sparse_sessions",
    "internal_holes", "gap_islands", "backfill_candidates", "symbol_map", "quarterise", "account_priority",
    "quarterly_rows", "top_universe", "universe_union", "validate_keys", "validate_bars", "listing_json",
    "wide_to_long", "statement_rows", "ticker_lines", "adhoc_sql", "publish_roundtrip", "stream_bars",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    for name in ("session_counts", "flagship"):
        run(name)
    seconds = {name: run(name) for name in HEADLINE}
    print(json.dumps({"metric": "panel_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
