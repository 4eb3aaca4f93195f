"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores. Each query is
run once to warm up and then ``BENCH_RUNS`` times; the median counts. Results
are written to the ``noop`` sink, so every row and column is computed.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from keycadence.plans.registry import QUERIES
from keycadence.session import build_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "1"))

HEADLINE = [
    "parse_events",
    "keystrokes",
    "encode_events",
    "user_stats",
    "global_rank",
    "result_records",
    "latest_results",
    "leaderboard",
    "lookup_with_default",
    "health_counts",
    "session_tracker",
    "session_tracker_salted",
    "event_counter",
    "event_counter_sliced",
    "score_text",
    "char_status",
    "completion",
    "stream_result_records",
    "stream_sessions",
]


def _seconds(spark, name: str) -> float:
    started = time.perf_counter()
    QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    spark = build_session(
        "keycadence-bench",
        f"local[{CPUS}]",
        **{
            "spark.sql.shuffle.partitions": CPUS,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in sys.argv[1:] or HEADLINE:
        _seconds(spark, name)
        times[name] = round(statistics.median(_seconds(spark, name) for _ in range(RUNS)), 3)
        print(f"{name}: {times[name]}", file=sys.stderr, flush=True)
    events = spark.read.parquet(f"{SF_DIR}/events.parquet").count()
    rates = {
        f"{name}_events_per_sec": round(events / times[name])
        for name in ("result_records", "session_tracker", "stream_result_records")
        if name in times
    }
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_headline_query_time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "cpus": int(CPUS),
                **rates,
            }
        )
    )


if __name__ == "__main__":
    main()
