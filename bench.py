"""Time the headline queries and print one JSON line.

Each query runs once to warm up and then BENCH_RUNS times; the median is reported. Results are fully
computed and dropped (noop sink). ``queries`` has the whole time of each, ``build`` the part that passes
before its DataFrame is returned: writing tables, running streams and planning. ``gold_build`` is the time of building
the gold tables that the dashboard queries read; it is part of no query.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from transitloom import registry
from transitloom.session import get_session

HEADLINE = (
    "line_speed_kpi", "ping_speed", "accessibility_kpi", "fleet_snapshot", "fact_clean", "line_dimension",
    "company_dimension", "route_map_points", "shape_length", "route_profile", "dashboard_day",
    "flatten_positions", "flatten_stop_forecast", "flatten_line_forecast", "stops_by_term", "request_lots",
    "stream_dedup", "stream_snapshot", "stream_speed",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = get_session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__driver__memory="8g",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds, build = {}, {}
    start = time.perf_counter()
    registry._gold(spark, sf_dir)  # the tables that the dashboards read, built once
    gold_build = round(time.perf_counter() - start, 3)
    for name in names:
        took, built = [], []
        for _ in range(runs + 1):
            start = time.perf_counter()
            found = registry.QUERIES[name](spark, sf_dir)
            built.append(time.perf_counter() - start)
            found.write.format("noop").mode("overwrite").save()
            took.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(took[1:]), 3)
        build[name] = round(statistics.median(built[1:]), 3)
    spark.stop()
    print(json.dumps({
        "metric": "headline queries, total of median seconds", "value": round(sum(seconds.values()), 3),
        "unit": "sec", "queries": seconds, "build": build, "gold_build": gold_build, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cpus": int(cpus), "runs": runs,
    }))


if __name__ == "__main__":
    main()
