"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR  parquet folder (default /root/testdata/sf0.1)
BENCH_CPUS    local cores (default 8)
BENCH_RUNS    timed runs per query after one warm-up, the median counts (default 1)
BENCH_ALL     any value: time every registered query
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from forecourt.queries import QUERIES  # noqa: E402
from forecourt.session import local_session  # noqa: E402

HEADLINE = """
kpi_sales_month_format kpi_sales_star kpi_top_areas kpi_inquiry_channel kpi_sales_per_customer
kpi_where dq_metrics dq_dedup dq_pk_violations dq_fk_orphans silver_contracts gold_store_monthly
gold_market_margin gold_margin_score gold_rm_segment mv_dashboard_kpi mv_incremental
masked_customers doc_elements doc_chunks note_topics note_profile vector_topk chunk_topk
q_store_ranking q_top3_segment q_funnel q_store_decline q_heatmap q_margin_drop q_trend
medallion_gold
""".split()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    names = list(QUERIES) if os.environ.get("BENCH_ALL") else HEADLINE
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))

    def timed(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    for name in names:
        timed(name)
        seconds[name] = round(statistics.median(timed(name) for _ in range(runs)), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
