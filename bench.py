"""Time the headline queries; prints one JSON line.

Each query runs once to warm up and then three times; the median counts. Rows
go to Spark's ``noop`` sink, so every column is computed and nothing collected.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from strata.plans import catalog
from strata.session import build_session

HEADLINE = (
    "gold_category",
    "gold_author",
    "contract_valid",
    "ingest_counts",
    "silver_dedup",
    "silver_upsert",
    "quality_gate",
    "chunk_documents",
    "bm25_stats",
    "bm25_topk",
    "keyword_topk",
    "dense_topk",
    "dense_topk_chunks",
    "hybrid_search",
    "grounded_answer",
)
RUNS = 3


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        {
            "spark.master": f"local[{cpus}]",
            "spark.driver.memory": "8g",
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = catalog.registered()

    def timed(work) -> float:
        start = time.perf_counter()
        work()
        return time.perf_counter() - start

    def run(name: str) -> None:
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

    catalog.shared_index(spark, sf_dir)
    seconds = {"index_build": statistics.median(timed(lambda: catalog.new_index(spark, sf_dir)) for _ in range(RUNS))}
    for name in HEADLINE:
        run(name)
        seconds[name] = statistics.median(timed(lambda: run(name)) for _ in range(RUNS))
    rounded = {name: round(value, 3) for name, value in seconds.items()}
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": rounded,
                "sf": os.path.basename(sf_dir.rstrip("/")),
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()
