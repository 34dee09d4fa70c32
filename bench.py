"""Times the headline queries and prints one JSON line.

Reads $BENCH_SF_DIR (default /root/testdata/sf0.1) on local[$BENCH_CPUS].
Every query runs three times; the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from textlode.plans.queries import QUERIES
from textlode.session import build_session

HEADLINE = [
    "clear_text",
    "clean_social",
    "token_spans",
    "dedup_first",
    "top_words",
    "text_stats",
    "triples_from_rel",
    "embed_hash",
    "mean_pool",
    "knn_ip",
    "bm25_top_n",
    "hybrid_v1",
    "containing_doc",
    "fragment_search",
    "phrase_positions",
]


def run(spark, name: str, sf_dir: str) -> float:
    started = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "textlode-bench",
        f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "12g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        seconds[name] = round(statistics.median(run(spark, name, sf_dir) for _ in range(3)), 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr)
    print(
        json.dumps(
            {
                "metric": "headline queries, sum of medians of three runs",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
