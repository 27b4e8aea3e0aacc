"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from headway.session import build_session  # noqa: E402
from workload.queries import QUERIES  # noqa: E402

HEADLINES = (
    "bus_boardings",
    "bus_stop_delays",
    "bus_link_traversals",
    "person_trips",
    "throughput_peaks",
    "transit_route_ratio",
    "service_coverage",
    "m_on_time",
    "m_travel_time",
    "m_productivity",
    "m_bus_transfer",
    "score_record",
    "scores_by_run",
)
#: the whole analysis through the event store, and two state machines by range scans.
EXTRA = ("analysis", "bus_boardings_chunked", "person_trips_chunked")


def timed(spark, sf: str, name: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    rounds = int(os.environ.get("BENCH_ROUNDS", "3"))
    names = sys.argv[1:] or HEADLINES + EXTRA
    spark = build_session(
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false",
        spark__driver__memory="16g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        timed(spark, sf, name)  # warm-up
        seconds[name] = round(statistics.median(timed(spark, sf, name) for _ in range(rounds)), 3)
        print(name, seconds[name], file=sys.stderr)
    total = round(sum(v for k, v in seconds.items() if k not in EXTRA), 3)
    print(
        json.dumps(
            {
                "metric": "sum of median warm seconds over the headline queries",
                "value": total,
                "unit": "sec",
                "queries": {k: v for k, v in seconds.items() if k not in EXTRA},
                "extra": {k: v for k, v in seconds.items() if k in EXTRA},
                "sf": os.path.basename(sf.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
