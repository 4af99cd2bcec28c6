"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR, BENCH_CPUS and BENCH_RUNS choose the data, the cores and how many
timed runs each query gets after one warm-up (the median counts).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from registry.queries import QUERIES  # noqa: E402
from tidemark.session import local_session  # noqa: E402

HEADLINE = (
    "normalized_text",
    "clean_posts",
    "lexical_scores",
    "composite_signal",
    "tfidf_weights",
    "svd_scores",
    "signal_buckets",
    "bootstrap_intervals",
    "hashtag_summary",
    "capped_per_hashtag",
    "downsampled_events",
    "json_lines_source",
    "posts_from_pages",
    "signal_report",
)


def timed(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus)
    seconds = {}
    for name in names:
        timed(spark, name, sf_dir)
        seconds[name] = round(statistics.median(timed(spark, name, sf_dir) for _ in range(runs)), 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    spark.stop()
    print(json.dumps({
        "metric": "total_seconds_headline_queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
