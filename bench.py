"""Time the registered queries and print one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the local threads. Every query runs to a sink that
drops the rows, once to warm up and then BENCH_RUNS times; the median counts. A query's time
includes planning and reading, starting from the written tables before it (as in a rebuild).
`rebuild_all` is the time to write all derived tables anew from the given ones.
"""

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from checks.registry import queries, rebuild  # noqa: E402

HEADLINE = [
    "handicaps",
    "adjusted_scores",
    "season_event_summary",
    "season_players_summary",
    "season_log",
    "season_hole_scores",
    "clean_scores",
    "hole_unpivot",
    "prune_hole_scores",
    "import_plan",
    "page_links_resolved",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    wanted = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="run-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    known = queries()
    seconds = {}
    for name in wanted:
        times = []
        for _ in range(runs + 1):
            started = time.perf_counter()
            known[name](spark, folder).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - started)
        seconds[name] = round(statistics.median(times[1:]), 3)
    if "BENCH_QUERIES" not in os.environ:
        started = time.perf_counter()
        rebuild(spark, folder)
        seconds["rebuild_all"] = round(time.perf_counter() - started, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_warm_query_time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
