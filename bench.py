"""Times the headline queries and prints one JSON line.

Each query is written to a no-op sink: once to warm up, then BENCH_RUNS times
(default 3); the median counts. BENCH_SF_DIR and BENCH_CPUS choose data and cores.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from rooftally.catalog import QUERIES  # noqa: E402
from rooftally.session import local_session  # noqa: E402

HEADLINE = (
    "normalize_listings", "normalize_documents", "spam_documents", "sigma_events", "sigma_lineitem_parts",
    "valid_listings", "dedup_first", "dedup_documents", "nightly_survivors", "json_landing_survivors",
    "nightly_counts", "document_batches", "document_sink", "warehouse_append", "nightly_both_sinks",
)

# Rows that a query cleans or loads, for its rate: listings, documents, events or line items.
INPUT = {
    **dict.fromkeys(("normalize_documents", "spam_documents", "dedup_documents"), "documents"),
    "sigma_events": "events", "sigma_lineitem_parts": "lineitem",
}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    wanted = sys.argv[1:] or HEADLINE
    spark = local_session(cores)
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in wanted:
        timings = []
        for _ in range(runs + 1):
            started = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            timings.append(time.perf_counter() - started)
        seconds[name] = round(statistics.median(timings[1:]), 3)
    rates = {}
    for name in wanted:
        rows = spark.read.parquet(f"{sf_dir}/{INPUT.get(name, 'orders')}.parquet").count()
        rates[name] = round(rows / seconds[name])
    scale = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "total_median_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "rows_per_second": rates, "sf": float(scale.group(1)) if scale else None, "cpus": cores,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
