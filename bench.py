"""Headline queries, and the state ranking from a stored rollup against base tables.

Prints one JSON line. Every query runs once to warm up; the faster of two further
runs counts, from building the frame to the last row. The rollup comparison takes
the median of eight runs after one warm-up.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tallyport.operators import diagnostics, metrics, rollups  # noqa: E402
from tallyport.plans import star  # noqa: E402
from tallyport.session import local_session  # noqa: E402
from tallyport.star_roles import from_star  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = 8

HEADLINE = [
    "mv_monthly_sales", "mv_state_sales", "mv_category_sales", "mv_delivery_perf", "mv_seller_perf",
    "mv_payment_dist", "worst_sellers", "delivery_routes", "weight_freight_ontime", "negative_categories",
    "installment_share", "metric_base_fallback", "reconcile_state_sales", "anomaly_alerts", "what_if_remove_worst",
    "forecast_weekly", "review_keywords", "review_themes_neg", "question_reports", "followup_context",
    "dedupe_keep_first", "screen_sql_log",
]


def timed(make) -> float:
    start = time.perf_counter()
    make().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def median_ms(make) -> float:
    timed(make)
    return statistics.median(timed(make) for _ in range(RUNS)) * 1000


def main() -> None:
    spark = local_session("bench", cores=CPUS, shuffle_partitions=int(CPUS), memory="12g")
    seconds = {}
    for name in HEADLINE:
        runs = [timed(lambda: star.QUERIES[name](spark, SF_DIR)) for _ in range(3)]
        seconds[name] = round(min(runs[1:]), 3)
    shop = from_star(spark, SF_DIR)
    folder = tempfile.mkdtemp(prefix="tallyport-bench-")
    start = time.perf_counter()
    rollups.refresh(spark, shop, folder).collect()
    refresh = time.perf_counter() - start
    stored = rollups.read_all(spark, folder)["mv_state_sales"]
    view = median_ms(lambda: metrics.state_ranking(stored, star.YEAR))
    base = median_ms(lambda: diagnostics.state_ranking_base(shop, star.YEAR))
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "cpus": int(CPUS),
                "rollup_refresh_sec": round(refresh, 3),
                "state_ranking_view_median_ms": round(view, 1),
                "state_ranking_base_median_ms": round(base, 1),
                "view_speedup": round(base / view, 2),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
