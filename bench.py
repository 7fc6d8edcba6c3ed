"""Benchmark of the headline queries.

Runs each query on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]``; every run executes the whole plan into Spark's ``noop``
sink (no collect to the driver).  Prints one JSON line with the median of the
warm runs per query and their sum as the headline value.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

HEADLINE = ["occurrence_summary", "lineitem_summary", "pivot_merge", "validate_occurrences",
            "reject_report",
            "upsert_all", "upsert_evidence", "sections_wide", "chunks", "knn_topk",
            "search_post", "batch_search", "embed_chunks"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
    from lodestone.plans.queries import REGISTRY
    from lodestone.session import build_session

    spark = build_session(f"local[{cpus}]", app="lodestone-bench",
                          shuffle_partitions=int(cpus) * 2,
                          extra={"spark.driver.memory": "16g"})
    times: dict[str, float | None] = {}
    for name in names:
        samples = []
        try:
            for i in range(runs + 1):  # first run warms the JVM and file caches
                t0 = time.perf_counter()
                REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
                if i:
                    samples.append(time.perf_counter() - t0)
            times[name] = round(statistics.median(samples), 3)
        except Exception as e:  # record the failure, keep measuring the others
            print(f"{name} failed: {type(e).__name__}: {str(e)[:300]}", file=sys.stderr)
            times[name] = None
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    total = round(sum(t for t in times.values() if t is not None), 3)
    print(json.dumps({"metric": "headline_queries_total_median", "value": total,
                      "unit": "sec", "queries": times, "sf": sf}))


if __name__ == "__main__":
    main()
