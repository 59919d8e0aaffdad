"""Times the headline queries at one scale factor and prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from telemill.acceptance import QUERIES  # noqa: E402
from telemill.operators import rules  # noqa: E402
from telemill.session import build_session  # noqa: E402

HEADLINE = [
    "decode_messages",
    "cleaned_messages",
    "rule_lookup",
    "avg_tumbling",
    "avg_multi_granularity",
    "avg_rollover",
    "avg_out_of_order",
    "sample_messages",
    "device_value",
    "message_metrics",
]
# Timed once, as they write and read stores or streams of their own.
WHOLE = ["scan_main_day", "stream_clean"]
RUNS = 3


def run(spark, name: str, sf_dir: str) -> float:
    begin = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - begin


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE + WHOLE
    spark = build_session(
        cores,
        "bench",
        spark__sql__shuffle__partitions=cores if cores.isdigit() else "8",
        spark__driver__memory="16g",
        spark__checkpoint__dir=tempfile.mkdtemp(prefix="run-"),
    )
    seconds = {}
    for name in names:
        if name in WHOLE:
            seconds[name] = round(run(spark, name, sf_dir), 3)
            continue
        run(spark, name, sf_dir)
        seconds[name] = round(statistics.median(run(spark, name, sf_dir) for _ in range(RUNS)), 3)
    # The same lookup with both sides shuffled, as beyond the broadcast limit.
    if not sys.argv[1:]:
        limit, rules.BROADCAST_BYTES = rules.BROADCAST_BYTES, 0
        run(spark, "rule_lookup", sf_dir)
        seconds["rule_lookup_shuffled"] = round(run(spark, "rule_lookup", sf_dir), 3)
        rules.BROADCAST_BYTES = limit
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds[name] for name in seconds if name in HEADLINE), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cores": cores,
            }
        )
    )


if __name__ == "__main__":
    main()
