"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the number of local cores, BENCH_QUERIES
(optional, comma-separated or "all") the queries. Each query is run once to warm up
and then timed, the result going to Spark's no-op sink so that every row is made.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from hylle import suite  # noqa: E402
from hylle.session import build_session  # noqa: E402

HEADLINE = (
    "entry_subcategory_prices",
    "sf1_clean_text_documents",
    "sf13_subcategory_documents",
    "sf14_brand_documents",
    "pl1_enrich_store1",
    "pl2_enrich_store2",
    "sf17_parse_product_info",
    "wn1_contiguous_pages",
    "wn3_products_per_category",
    "wn4_first_occurrence",
    "ag4_links_per_page",
    "sk2_replace_files",
    "sk3_upsert_table",
    "sk4_insert_if_absent",
    "jn4_match_run_ids",
    "sk7_end_runs",
    "hx1_plain_links",
    "hx1_links_by_word",
    "hx3_product_record_store1",
    "hx6_card_record_store2",
    "pl4_crawl_store1",
    "pl5_crawl_store2",
    "pl6_ingest_products",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    wanted = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE))
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    suite.load()
    names = sorted(suite.QUERIES) if wanted == "all" else wanted.split(",")
    spark = build_session("hylle-bench", cores=cores)
    spark.sparkContext.setLogLevel("ERROR")
    times, cold = {}, {}
    for name in names:
        for attempt in range(runs + 1):
            start = time.perf_counter()
            suite.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            took = round(time.perf_counter() - start, 3)
            if attempt == 0:
                cold[name] = took
            else:
                times[name] = min(took, times.get(name, took))
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_warm_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "cold": cold,
                "sf": sf_dir.rstrip("/").split("sf")[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
