"""Seconds per headline query at $BENCH_SF_DIR on local[$BENCH_CPUS]; one JSON line."""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

from textmill.registry import all_queries
from textmill.session import build_session

HEADLINE = [
    "heuristic_kept_by_lang",
    "chunk_text",
    "plan_file_split",
    "string_normalization",
    "text_metrics",
    "gopher_quality",
    "gopher_repetition",
    "heuristic_filtering",
    "detect_language",
    "toxic_spans",
    "perplexity_summary",
    "detect_pii_gazetteer",
    "pii_masking",
    "exact_dedup",
    "minhash_signature_64",
    "deduplication",
    "translate",
    "language_stats",
    "dataset_stats",
    "curation_chain",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.checkpoint.dir": os.environ.get("BENCH_SCRATCH") or tempfile.mkdtemp(prefix="bench-"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = all_queries()
    wanted = sys.argv[1:] or HEADLINE
    # One small query first, so that start-up is not charged to the first entry.
    queries["heuristic_kept_by_lang"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for key in wanted:
        started = time.time()
        queries[key](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[key] = round(time.time() - started, 3)
    found = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(found.group(1)) if found else sf_dir,
            }
        )
    )


if __name__ == "__main__":
    main()
