"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the data (default sf0.1), ``BENCH_CPUS`` the local cores.
"""

from __future__ import annotations

import json
import os
import time

from shelfwise.plans import all_queries
from shelfwise.session import build_session

HEADLINE = (
    "monthly_sales_by_packaging",
    "monthly_sales",
    "geo_rollup",
    "product_rollup",
    "weighted_prices",
    "quality_report",
    "publish_clear_view",
    "build_facts",
    "extract_weight_g",
    "packaging_type",
    "clean_place_text",
    "word_ngrams",
    "char_ngrams",
    "vocabulary",
    "tfidf",
    "stratified_split",
    "join_by_key",
    "join_article_or_barcode",
    "enrich_without_models",
    "score_distinct",
    "write_append",
    "stream_new_files",
    "train_region",
    "train_city",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "16g",
            "spark.sql.shuffle.partitions": cpus,
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    plans = all_queries()
    # Start-up of the session and the first scan are not part of any query.
    plans["derive_dates"](spark, sf_dir).collect()
    times = {}
    for name in HEADLINE:
        start = time.perf_counter()
        plans[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
