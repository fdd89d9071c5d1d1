"""Time the headline queries; prints one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py [query ...]
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from querybook import all_queries
from shelfmark.session import configure

HEADLINES = (
    "catalog_page", "catalog_page_deep", "filter_bounds", "search_multi", "search_text",
    "updated_since", "page_summary", "catalog_page_with_children", "catalog_export", "items_json",
    "children_flatten", "children_filtered", "children_nested", "children_images",
    "multi_relation", "children_split_parts", "items_updated_since", "item_by_id", "bulk_lookup",
    "bulk_lookup_with_children", "all_pages", "log_since_page", "log_retention", "rate_breach",
    "log_append", "log_ingest_stream", "rate_breach_stream", "incremental_extract", "table_sizes",
    "column_profile", "candidate_keys", "inclusion_dependency", "resource_specs",
)


def timed(spark: SparkSession, run, folder: str) -> float:
    """Seconds to build a query and compute every row and column of its result."""
    start = time.perf_counter()
    run(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = configure(SparkSession.builder.master(f"local[{cpus}]").appName("bench"))
    settings = {
        "spark.sql.shuffle.partitions": cpus,
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")

    book = all_queries()
    seconds = {}
    for name in sys.argv[1:] or HEADLINES:
        timed(spark, book[name].run, folder)  # compile and warm up
        seconds[name] = round(min(timed(spark, book[name].run, folder) for _ in range(2)), 3)
    spark.stop()
    result = {
        "metric": "total time of the headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": folder.rsplit("sf", 1)[-1],
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
