"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR and BENCH_CPUS choose the tables and the cores. Every query runs once to warm up and
then BENCH_RUNS times; the median counts. Results go to the noop sink, so all rows are computed.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from ratemill.plans.queries import QUERIES
from ratemill.session import get_spark

HEADLINE = [
    "csv_parse",
    "csv_quote_split",
    "feed_projection_factor",
    "classify_feed",
    "upsert_always",
    "upsert_insert_only",
    "upsert_changed",
    "upsert_multi_match",
    "merge_actions",
    "collapse_batch",
    "assign_ids",
    "duplicate_keys",
    "duplicate_keys_4col",
    "quarantine_good",
    "quarantine_rejects",
    "import_end_to_end",
    "import_two_months",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = get_spark("bench", cpus)
    seconds = {}
    for name in HEADLINE:
        times = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:]), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline queries, median of warm runs, total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": cpus,
                "runs": runs,
            }
        )
    )


if __name__ == "__main__":
    main()
