"""Headline queries on local[$BENCH_CPUS]; prints one JSON line with seconds per query."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from entry_queries import QUERIES  # noqa: E402
from kinseek.runtime import drop_staged, local_session  # noqa: E402

HEADLINE = (
    "link_notes",
    "patient_records",
    "link_conflicts",
    "lexical_topk",
    "lexical_topk_batch",
    "bm25_topk",
    "bm25_topk_batch",
    "dense_cosine_topk",
    "maxsim_rescore",
    "fused_candidates",
    "late_interaction",
    "cross_scores",
    "final_with_patient",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    names = sys.argv[1:] or HEADLINE
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    spark.read.parquet(f"{folder}/documents.parquet").count()  # start the executors
    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        drop_staged(spark)
    line = {
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }
    spark.stop()
    print(json.dumps(line))


if __name__ == "__main__":
    main()
