"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from signpost.plans.catalog import QUERIES  # noqa: E402
from signpost.session import build_session  # noqa: E402

HEADLINE = [
    "classify",
    "classify_text",
    "topk_candidates",
    "neighbor_graph",
    "graph_correction",
    "embed_texts",
    "embed_distinct",
    "lsh_candidates",
    "upsert_postings",
    "backfill_missing",
    "dedup_keep_first",
    "diff_result_store",
    "reconcile",
    "platform_rollup",
    "merge_progress",
    "normalize_job_ids",
    "format_structured",
    "parse_list_field",
    "read_postings_csv",
    "stream_throughput",
]


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES", "").split(",") if os.environ.get("BENCH_QUERIES") else HEADLINE
    spark = build_session(
        f"local[{cpus}]",
        "signpost-bench",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf}/documents.parquet").count()
    seconds = {}
    for name in names:
        runs = []
        for _ in range(int(os.environ.get("BENCH_RUNS", "2"))):
            start = time.perf_counter()
            QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        seconds[name] = round(min(runs), 3)
        print(name, [round(r, 2) for r in runs], file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries (best run each)",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
