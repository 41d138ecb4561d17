"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the data folder, BENCH_CPUS the local cores. Every query runs once to warm up
and is then timed; `query` is the time to write its whole result to the `noop` sink.
"""

from __future__ import annotations

import json
import os
import re
import time

from bumpwise.session import build_session
from suite.adapters import segments
from suite.queries import QUERIES, network_index

HEADLINES = (
    "detect_anomalies",
    "nearest_segment",
    "daily_segment_counts",
    "mart_segment_trend",
    "trip_stats",
    "parse_trips",
    "ingest_counters",
    "mart_daily_summary",
    "mart_repair_priority_by_segment",
    "merge_additive",
    "merge_stored",
    "bbox_filter_many",
    "split_links",
    "stream_ingest",
    "segment_endpoints",
    "repair_priorities_end_to_end",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session("bench", f"local[{cpus}]", shuffle_partitions=cpus)
    spark.sparkContext.setLogLevel("ERROR")
    segments(spark, sf_dir).count()
    seconds: dict[str, float] = {}
    started = time.perf_counter()
    network_index(spark, sf_dir)
    seconds["build_segment_index"] = round(time.perf_counter() - started, 3)
    for name in HEADLINES:
        for _ in range(2):
            started = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            spent = time.perf_counter() - started
        seconds[name] = round(spent, 3)
    scale = re.search(r"sf([\d.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "headline queries, total seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else None,
                "cpus": cpus,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
