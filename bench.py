"""Times the headline queries and prints one JSON line.

Every query is computed in full: its rows go to a sink that drops them.
BENCH_SF_DIR and BENCH_CPUS choose the tables and the number of cores;
BENCH_QUERIES (comma-separated) a subset.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ledgerpulse.plans.catalog import QUERIES  # noqa: E402
from ledgerpulse.session import build_session  # noqa: E402

HEADLINES = [
    "features_1day", "features_10min", "features_order_days", "alerts_by_merchant", "txn_log_left_join",
    "order_line_left_join", "first_log_per_txn", "failed_transactions", "critical_failures", "success_rate_by_merchant",
    "table_summary", "recent_txns_topn", "recent_logs_topn", "merchant_diagnostics", "detect_risk_block",
    "detect_auth_failure", "detect_overload", "webhook_update", "ingest_validated", "iforest_frozen_scores",
    "iforest_fit_predict", "lof_scores", "topk_vectors", "chunk_documents", "transcript_audit", "transcript_repair",
    "stream_features", "stream_scoring",
]
#: Timed as well, but not part of the total, which stays comparable with earlier rounds.
OTHERS = ["detect_risk_block_sliding", "kb_search_documents", "quality_report", "webhook_update_stored"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINES + OTHERS
    spark = build_session("ledgerpulse-bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "16g",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "128k",
        "spark.sql.files.maxPartitionBytes": "4m", "spark.sql.files.openCostInBytes": "1m"})
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds = time.perf_counter() - start
        spark.catalog.clearCache()
        return round(seconds, 3)

    for name in ("success_rate", "transcript_clean"):  # start the session's threads and Python workers
        run(name)
    timings = {name: run(name) for name in names}
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(t for n, t in timings.items() if n not in OTHERS), 3), "unit": "sec",
                      "queries": timings, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
