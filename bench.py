"""Time the headline queries; prints one JSON line.

Each query is built and written to the `noop` sink (all rows, all columns) after one warm-up
query; the best of three timed runs counts. The `wide_*` entries run
on 1.2 million rows x 218 signals derived from `lineitem` (at sf0.1), stored as one file per core
first; `wide_export` goes from those files to a written wide table.
"""

from __future__ import annotations

import json
import os
import sys
import time

from fleetframe import registry, views
from fleetframe.operators import dedup, enrich, gaps, pivot, quality
from fleetframe.session import create_session, materialize, work_path
from fleetframe.sources import tables

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

HEADLINE = [
    "measurements", "gap_points", "latest_wins", "merge_history", "stage_counts",
    "enrich_global", "enrich_per_ship", "restrict_active", "mapping_distinct", "catalog_first_wins",
    "explode_list_struct", "catalog_from_map", "timeseries_long", "timeseries_dense", "payload_quarantine",
    "run_audit", "gap_intervals_1d", "gap_sessions", "gaps_append", "signal_counts", "top_signals",
    "pivot_by_load", "pivot_latest", "pivot_conditional", "pivot_stats", "pivot_upsert",
    "merge_upsert_1key", "merge_upsert_3key", "daily_summary", "daily_delta", "latest_run_per_day",
    "history_last_run_per_ship", "landing_inventory",
]


def wide_queries(spark, sf_dir):
    """The published single-node steps at their scale: read, dedup, signals, pivot, names, gaps."""
    path = work_path(spark, "wide")
    views.wide_tele(spark, sf_dir).repartition(int(CPUS)).write.parquet(path)
    names = materialize(views.wide_tele(spark, sf_dir).select("signal").distinct().selectExpr(
        "signal", "upper(signal) AS friendly_name"))

    def rows():
        return quality.measurements(spark.read.parquet(path))

    def latest():
        return dedup.latest_wins(rows(), order=[*views.TIE_BREAK, "signal_value"])

    signals = pivot.signal_list(rows())
    cells = work_path(spark, "wide-cells")
    latest().write.parquet(cells)
    return {
        "wide_read": lambda: spark.read.parquet(path),
        "wide_null_filter": rows,
        "wide_latest_wins": latest,
        "wide_distinct_signals": lambda: pivot.distinct_signals(rows()),
        "wide_pivot": lambda: pivot.pivot_latest(spark.read.parquet(cells), signals),
        "wide_export": lambda: pivot.pivot_latest(latest(), pivot.signal_list(rows())),
        "wide_enrich": lambda: enrich.enrich_global(rows(), names),
        "wide_gaps": lambda: gaps.gap_intervals(quality.gap_points(spark.read.parquet(path))),
    }


def timed(name, build, target) -> float:
    start = time.perf_counter()
    if name == "wide_export":
        tables.export_pivot(build(), target)
    else:
        build().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    spark = create_session(
        "bench", f"local[{CPUS}]", spark__driver__memory="16g", spark__ui__enabled="false",
        spark__sql__shuffle__partitions=CPUS, spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    only = sys.argv[1:]
    names = [n for n in HEADLINE if not only or n in only]
    queries = {n: (lambda n=n: registry.QUERIES[n](spark, SF_DIR)) for n in names}
    queries |= {n: q for n, q in wide_queries(spark, SF_DIR).items() if not only or n in only}
    target = work_path(spark, "export")
    timed("warm-up", lambda: registry.QUERIES["pivot_latest"](spark, SF_DIR), target)
    seconds = {n: round(min(timed(n, q, target) for _ in range(RUNS)), 3) for n, q in queries.items()}
    print(json.dumps({
        "metric": "total_headline_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
