"""Choosing runs: last run per day, history window, retention."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetframe import scale
from fleetframe.sources.landing import newest_days

# Retention and history of a standard deployment, in days (fixed values).
DAYS_TO_KEEP = 90
HISTORY_DAYS = 5


def last_runs(runs: DataFrame, max_days: int | None = None, days: DataFrame | None = None) -> DataFrame:
    """One row (run_date, run_ts) per day: the day's last run.

    `days` (run_date) lists the days that have a run directory, with or without files; the day limit
    counts those. Without it the days of `runs` count. The result is bounded by the calendar.
    """
    latest = runs.groupBy("run_date").agg(F.max("run_ts").alias("run_ts"))
    if max_days is None:
        return latest
    if days is None:
        return latest.orderBy(F.desc("run_date")).limit(max_days)
    newest = days.select("run_date").distinct().orderBy(F.desc("run_date")).limit(max_days)
    return latest.join(F.broadcast(newest), "run_date", "left_semi")


def latest_run_per_day(df: DataFrame, max_days: int | None = None, days: DataFrame | None = None) -> DataFrame:
    """Rows of the last run of each day, newest `max_days` days.

    Only the run list is aggregated; the rows are filtered by a broadcast of one row per day.
    """
    chosen = last_runs(df.select("run_date", "run_ts"), max_days, days)
    return df.join(F.broadcast(chosen), ["run_date", "run_ts"], "left_semi")


def history_window(df: DataFrame, as_of: date, days: int = HISTORY_DAYS, before=None) -> DataFrame:
    """Per ship the last run of each of the last `days` days, looking only at the day's last hour.

    A ship that is missing in a day's last hour loses that day. `before` (a timestamp) excludes the
    current run and everything after it.
    """
    window = df.filter((F.col("run_date") > F.date_sub(F.lit(as_of), days)) & (F.col("run_date") <= F.lit(as_of)))
    if before is not None:
        window = window.filter(F.col("run_ts") < F.lit(before))
    hours = window.groupBy("run_date").agg(F.max(F.date_trunc("hour", "run_ts")).alias("run_hour"))
    in_hour = window.withColumn("run_hour", F.date_trunc("hour", "run_ts")).join(
        F.broadcast(hours), ["run_date", "run_hour"], "left_semi"
    )
    # (ship, day) -> last run: combined on the map side, then a small list to filter by.
    last = in_hour.groupBy("imo", "run_date").agg(F.max("run_ts").alias("run_ts"))
    return scale.semi_join(in_hour, last, ["imo", "run_date", "run_ts"]).select(*df.columns)


def last_run_per_ship(df: DataFrame, as_of: date, days: int = HISTORY_DAYS, before=None) -> DataFrame:
    """Per ship the last run of each of the last `days` days, in whatever hour it was.

    `before` (a timestamp) excludes the current run and everything after it.
    """
    window = df.filter((F.col("run_date") > F.date_sub(F.lit(as_of), days)) & (F.col("run_date") <= F.lit(as_of)))
    if before is not None:
        window = window.filter(F.col("run_ts") < F.lit(before))
    last = window.groupBy("imo", "run_date").agg(F.max("run_ts").alias("run_ts"))
    return scale.semi_join(window, last, ["imo", "run_date", "run_ts"]).select(*df.columns)


def retention(df: DataFrame, as_of: date, days_to_keep: int = DAYS_TO_KEEP) -> DataFrame:
    """Mark rows as expired: strictly older than `as_of - days_to_keep`. Nothing is deleted."""
    return df.withColumn("expired", F.col("run_date") < F.date_sub(F.lit(as_of), days_to_keep))


def expired(df: DataFrame, as_of: date, days_to_keep: int = DAYS_TO_KEEP) -> DataFrame:
    """The dry-run list: partitions that retention would remove, with their row counts."""
    old = df.filter(F.col("run_date") < F.date_sub(F.lit(as_of), days_to_keep))
    return old.groupBy("run_date").agg(F.count(F.lit(1)).alias("row_count"))


def kept(df: DataFrame, as_of: date, days_to_keep: int = DAYS_TO_KEEP) -> DataFrame:
    return df.filter(F.col("run_date") >= F.date_sub(F.lit(as_of), days_to_keep))


__all__ = [
    "DAYS_TO_KEEP",
    "HISTORY_DAYS",
    "expired",
    "history_window",
    "kept",
    "last_run_per_ship",
    "last_runs",
    "latest_run_per_day",
    "newest_days",
    "retention",
]
