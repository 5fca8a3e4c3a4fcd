"""Run a stream over data at hand as a schedule would: part after part arrives, one start per part.

The parts and the results are tables in the shared folder.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fleetframe.functions import run_time
from fleetframe.session import materialize, work_path
from fleetframe.sources.landing import write_files, write_landing
from fleetframe.sources.tables import append_table, read_table
from fleetframe.streaming import keyed_gaps, streams

# Ship id of the row that moves the watermark past all real rows at the end of a replay.
END_MARK = ""

POINTS = "imo string, signal string, signal_timestamp timestamp, signal_value double, loaddate string"
INTERVALS = "imo string, signal string, gap_start timestamp, gap_end timestamp, loaddate string"


def run(query: StreamingQuery) -> None:
    query.awaitTermination()


def split_by_time(df: DataFrame, time: str, parts: int) -> list[DataFrame]:
    """Equal ranges of `time`, oldest first; together all rows, those without a time in the first."""
    low, high = df.agg(F.unix_micros(F.min(time)), F.unix_micros(F.max(time))).first()
    if low is None:
        return [df]
    part = F.coalesce(F.floor((F.unix_micros(F.col(time)) - low) * parts / F.lit(high - low + 1)), F.lit(0))
    return [df.filter(part == i) for i in range(parts)]


def landing(spark: SparkSession, payloads: DataFrame) -> DataFrame:
    """Payloads arrive in two parts, the newer one first."""
    folder = work_path(spark, "stream-landing")
    dated = materialize(payloads).withColumn("load_ts", run_time("loaddate"))
    for part in reversed(split_by_time(dated, "load_ts", 2)):
        write_landing(part, f"{folder}/landing")
        bundles = streams.landing_bundles(spark, f"{folder}/landing", "Timeseries")
        run(streams.start_landing(bundles, f"{folder}/long", f"{folder}/checkpoint"))
    return read_table(spark, f"{folder}/long", POINTS)


def landing_runs(spark: SparkSession, payloads: DataFrame) -> DataFrame:
    """Payloads arrive in two parts as files, the older runs first."""
    folder = work_path(spark, "stream-runs")
    dated = materialize(payloads).withColumn("load_ts", run_time("loaddate"))
    for part in split_by_time(dated, "load_ts", 2):
        write_files(part, f"{folder}/landing")
        files = streams.landing_runs(spark, f"{folder}/landing", "Timeseries")
        run(streams.start_landing(files, f"{folder}/long", f"{folder}/checkpoint"))
    return read_table(spark, f"{folder}/long", POINTS)


def latest_wins(rows: DataFrame, order: list[str]) -> DataFrame:
    """Rows arrive newest part first: later parts bring older loads of known points."""
    spark = rows.sparkSession
    folder = work_path(spark, "stream-latest")
    dated = rows.withColumn("load_ts", run_time("loaddate"))
    _replay(
        [p.drop("load_ts") for p in reversed(split_by_time(dated, "load_ts", 3))],
        folder,
        lambda stream: streams.start_latest_wins(stream, f"{folder}/table", f"{folder}/checkpoint", order),
    )
    return read_table(spark, f"{folder}/table", rows.schema).select(*rows.columns)


def gap_sessions(points: DataFrame, threshold: timedelta) -> DataFrame:
    spark = points.sparkSession
    folder = work_path(spark, "stream-gaps")
    rows = points.select("imo", "signal", "gap_start", "loaddate")
    last = rows.agg(F.max("gap_start").alias("last"))
    end = last.select(
        F.lit(END_MARK).alias("imo"), F.lit(END_MARK).alias("signal"),
        (F.col("last") + F.expr("INTERVAL 1000 DAYS")).alias("gap_start"), F.lit(None).cast("string").alias("loaddate"),
    )
    _replay(
        [*split_by_time(rows, "gap_start", 3), end],
        folder,
        lambda stream: streams.start_gap_sessions(stream, f"{folder}/gaps", f"{folder}/checkpoint", threshold),
    )
    return read_table(spark, f"{folder}/gaps", INTERVALS).filter(F.col("imo") != END_MARK)


def late_gaps(points: DataFrame, threshold: timedelta, late: timedelta) -> DataFrame:
    """Points arrive newest part first, so most are later than `late`; the side table brings them back."""
    spark = points.sparkSession
    folder = work_path(spark, "stream-late")
    rows = points.select("imo", "signal", "gap_start", "loaddate")
    last = rows.agg(F.max("gap_start").alias("last"))
    end = last.select(
        F.lit(END_MARK).alias("imo"), F.lit(END_MARK).alias("signal"),
        (F.col("last") + F.expr("INTERVAL 1000 DAYS")).alias("gap_start"), F.lit(None).cast("string").alias("loaddate"),
    )

    def start(stream: DataFrame) -> StreamingQuery:
        run(streams.start_late_rows(stream, f"{folder}/late", f"{folder}/late-checkpoint", late=late))
        return streams.start_gap_sessions(stream, f"{folder}/gaps", f"{folder}/checkpoint", threshold, late)

    _replay([*reversed(split_by_time(rows, "gap_start", 3)), end], folder, start)
    stored = read_table(spark, f"{folder}/gaps", INTERVALS).filter(F.col("imo") != END_MARK)
    side = read_table(spark, f"{folder}/late", rows.schema).filter(F.col("imo") != END_MARK)
    return streams.merge_late_gaps(stored, side, threshold)


def gap_state(points: DataFrame, threshold: timedelta) -> DataFrame:
    """Points arrive newest part first: the later parts extend and join intervals that are already stored."""
    spark = points.sparkSession
    folder = work_path(spark, "stream-gap-state")
    rows = points.select("imo", "signal", "gap_start", "loaddate")
    _replay(
        list(reversed(split_by_time(rows, "gap_start", 3))),
        folder,
        lambda stream: keyed_gaps.start_gaps(stream, f"{folder}/gaps", f"{folder}/checkpoint", threshold),
    )
    return read_table(spark, f"{folder}/gaps", keyed_gaps.INTERVALS).drop("gap_date")


def first_seen(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Rows arrive oldest load first."""
    spark = rows.sparkSession
    folder = work_path(spark, "stream-first")
    dated = rows.withColumn("load_ts", run_time("loaddate"))
    _replay(
        [p.drop("load_ts") for p in split_by_time(dated, "load_ts", 3)],
        folder,
        lambda stream: streams.start_first_seen(stream, f"{folder}/first", f"{folder}/checkpoint", keys, order=order),
    )
    return read_table(spark, f"{folder}/first", rows.schema).select(*rows.columns)


def _replay(parts: list[DataFrame], folder: str, start: Callable[[DataFrame], StreamingQuery]) -> None:
    spark = parts[0].sparkSession
    for part in parts:
        append_table(part, f"{folder}/input")
        run(start(streams.long_stream(spark, f"{folder}/input", part.schema)))
