"""Time the headline queries once warm and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_RUNS (default 1).
"""

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from hearthside.plans.catalog import QUERIES  # noqa: E402
from hearthside.session import build_session, release  # noqa: E402

HEADLINE = [
    "market_median_ppsqm_by_city", "market_stats", "market_avg_by_governorate", "market_value_counts", "affordable_cities",
    "price_by_bedrooms", "amenity_share", "budget_summary", "city_coords", "geo_grid", "price_histogram", "price_quartiles",
    "search_filtered", "search_paged", "search_options", "search_option_bounds", "dedup_first", "dedup_rows", "search_table_ids",
    "verdicts", "deal_rank", "compare_norm", "extracted_english", "extracted_arabic", "delivery_months", "coverage_report",
    "null_report", "fill_mean", "outlier_iqr", "one_hot", "ratio_features", "prompt_batches", "page_text", "page_links",
    "page_record", "resumed_ingest", "stateful_ingest", "csv_round_trip", "map_centre", "text_clean", "target_encoded", "standard_scaled", "regression_metrics", "incremental_ingest",
    "fold_encoded", "linear_by_area", "search_keyset", "ingest_versions", "merged_statistics", "delivery_steps",
]


def run(query, spark, sf_dir):
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = time.perf_counter() - start
    release()
    return seconds


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    spark = build_session("bench", f"local[{cpus}]", **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in HEADLINE:
        run(QUERIES[name], spark, sf_dir)  # warm-up
        times[name] = round(statistics.median(run(QUERIES[name], spark, sf_dir) for _ in range(runs)), 3)
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    print(
        json.dumps(
            {
                "metric": "total_seconds_headline_queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "listing_rows": rows,
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()
