"""Times the headline queries on one data folder and prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from recordmill.catalog import QUERIES
from recordmill.session import build_session

HEADLINE = [
    "domain_counts", "dedup_report", "change_cases", "latest_per_key", "upsert_merge",
    "checkpoint_fold", "freshness_gate", "freshness_by_source", "parse_timestamp", "validate_job",
    "validate_product", "route_dlq", "resolve_all", "mapping_log", "simhash64", "near_duplicates",
    "near_dup_window", "structural_chunks", "merge_partials", "html_page_extract", "rss_news",
    "jobs_json_flat", "atom_papers", "entities_mentioned", "role_family", "audit_papers",
    "audit_news", "crawl_metrics", "systematic_sample", "similar_vectors", "export_tabs_csv",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cores}]",
        **{
            "spark.sql.shuffle.partitions": cores, "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()
    seconds: dict[str, float] = {}
    for name in HEADLINE:
        started = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    spark.stop()
    print(json.dumps({
        "metric": "headline_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": folder.rstrip("/").rsplit("/sf", 1)[-1],
    }))


if __name__ == "__main__":
    main()
