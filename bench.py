"""Times the headline queries; prints one JSON line.

Folder of tables and number of cores come from BENCH_SF_DIR and BENCH_CPUS. Every query
runs to its last row into a sink that drops rows, BENCH_RUNS times after a first run that
is not counted; the best time counts.
"""

from __future__ import annotations

import json
import os
import pathlib
import sys
import time

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent))

from lapwise.queries import collect  # noqa: E402
from lapwise.session import build_session  # noqa: E402

HEADLINE = [
    "fastest_effort", "fastest_effort_ladder", "fastest_effort_uneven", "point_deltas", "lap_assign",
    "length_renumber", "intensity_align", "sport_class", "running_over_distance", "longest_multi_session",
    "activity_totals", "timestamp_fallback", "nearest_place", "insert_if_absent", "fk_kept", "pool_update",
    "power_backfill", "message_router", "quarantine", "json_paths", "filename_fields", "tcx_points", "gpx_points",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "lapwise-bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__driver__memory="16g",
        spark__ui__enabled="false", spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries, _ = collect()
    times = {}
    for name in names:
        took = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            took.append(time.perf_counter() - start)
        times[name] = round(min(took[1:] or took), 3)
    spark.stop()
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": pathlib.Path(sf_dir).name.removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
