"""Time the headline queries: prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores, ``BENCH_RUNS`` the runs per
query after one warm-up (the median counts). Results go to the ``noop`` sink, so every row
is computed and none is collected. Streaming queries are timed once, start to end.
"""

from __future__ import annotations

import json
import os
import statistics as stats
import time

from forgemeter.operators import aggregates
from forgemeter.plans.catalogue import QUERIES, _valid
from forgemeter.session import build_session

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 4))
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

BATCH = [
    "clean_events",
    "envelope_clean_events",
    "raw_event_flatten",
    "ingest_records",
    "repo_language_lookup",
    "dedup_events",
    "repo_stats",
    "actor_stats",
    "window_activity",
    "language_stats",
    "top_repos_global",
    "top_actors_global",
    "top10_repos_stars",
    "top10_languages",
    "overview_totals",
    "window_panel_push_speed",
    "gate_history",
]
STREAMS = ["stream_window_activity", "stream_repo_stats", "stream_actor_stats", "stream_dedup"]

# The approximate forms, which a live run uses; the catalogue lists the exact ones.
APPROX = {
    "repo_stats_approx": aggregates.repo_stats,
    "window_activity_approx": aggregates.window_activity,
}


def timed(run) -> float:
    start = time.perf_counter()
    run()
    return time.perf_counter() - start


def force(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = build_session(
        "bench",
        master=f"local[{CPUS}]",
        settings={
            "spark.sql.shuffle.partitions": CPUS,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    cases = {n: (lambda n=n: force(QUERIES[n](spark, FOLDER))) for n in BATCH}
    cases |= {n: (lambda f=f: force(f(_valid(spark, FOLDER)))) for n, f in APPROX.items()}
    seconds = {}
    for name, run in cases.items():
        run()
        seconds[name] = round(stats.median(timed(run) for _ in range(RUNS)), 3)
    for name in STREAMS:
        seconds[name] = round(timed(lambda n=name: force(QUERIES[n](spark, FOLDER))), 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
                "cpus": CPUS,
            }
        )
    )


if __name__ == "__main__":
    main()
