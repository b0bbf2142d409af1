"""Headline timings: one JSON line.

Each query runs once to warm up and then three times; the median counts. The
result is written to the ``noop`` sink, so every row and column is computed.
Queries that write and read back folders are timed with their writes.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

HEADLINE = [
    "reconcile_coverage",
    "carry_forward",
    "dedupe_oldest",
    "dedupe_latest",
    "upsert_nullsafe",
    "upsert_strict",
    "left_join_fanout",
    "topn_per_group",
    "agg_sum",
    "pivot_metrics",
    "flatten_json",
    "explode_items",
    "cast_coerce_null",
    "parse_money",
    "parse_dates",
    "extract_phones",
    "html_links",
    "html_elements",
    "html_strip_tags",
    "catalogue_join",
    "sink_partitioned",
    "scan_preamble_csv",
]


def main() -> None:
    from bazaar.checks import QUERIES
    from bazaar.session import local_session, prepare

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = prepare(local_session("bazaar-bench", cores))
    names = sys.argv[1:] or HEADLINE

    def once(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    for name in names:
        once(name)
        seconds[name] = round(statistics.median(once(name) for _ in range(3)), 3)
        print(name, seconds[name], file=sys.stderr)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
