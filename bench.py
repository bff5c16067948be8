"""Time the headline queries; prints one JSON line.

Every query runs whole, into Spark's noop sink, once to warm up and then BENCH_RUNS times
(default 2); the best time counts.
"""

import json
import os
import sys
import time

from checks import registry
from danji.session import local_session

HEADLINE = [
    "monthly_median_volume", "sales_overview", "individual_trades", "region_hierarchy_complex",
    "preprocess_trades", "derive_trade_columns", "join_coords", "backfill_legacy_coords",
    "volume_by_complex", "best_emd", "best_coords", "complex_pivot", "complex_ranking",
    "year_pivot_volume", "tracking_report", "nearest_month_price", "roi_report", "validate_targets",
    "yoy_self_join", "indicator_map", "heatmap_pivot", "choropleth_feed", "filter_effect",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    registry.load()
    spark = local_session("bench", cores)
    seconds = {}
    for name in HEADLINE:
        best = None
        for attempt in range(runs + 1):
            start = time.perf_counter()
            df = registry.QUERIES[name](spark, sf_dir)
            df.write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - start
            if attempt and (best is None or took < best):
                best = took
        seconds[name] = round(best, 3)
        print(f"{name} {best:.2f}s", file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")),
                "cores": cores,
            }
        )
    )


if __name__ == "__main__":
    main()
