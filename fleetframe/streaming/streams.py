"""Streaming operators. Each returns a started query that stops when the available input is done.

A scheduled run is one start with `trigger(availableNow=True)`: the checkpoint remembers what was
read. Give `trigger={"processingTime": "15 minutes"}` for a query that keeps running.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from datetime import timedelta

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamReader, StreamingQuery

from fleetframe import schemas
from fleetframe.operators.dedup import combine, first_wins, latest_wins
from fleetframe.operators.gaps import GAP_THRESHOLD, SERIES, merge_points
from fleetframe.operators.nested import timeseries_to_long
from fleetframe.operators.quality import split_errors
from fleetframe.sources import landing_source
from fleetframe.sources.landing import BUNDLE_SCHEMA, path_parts
from fleetframe.sources.runs import HISTORY_DAYS
from fleetframe.sources.tables import of_dates, overwrite_partitions, read_table, replace_partition

ONCE = {"availableNow": True}

# How late a row may be (the overlap of the loads). Later ones go to a side table (`start_late_rows`),
# from which `merge_late_gaps` brings them into the result.
LATE_ROWS = timedelta(days=HISTORY_DAYS)

# Intake of one batch of a stream over files: a backlog becomes several batches.
MAX_FILES = 10_000


def _limited(reader: DataStreamReader, max_files: int = MAX_FILES) -> DataStreamReader:
    return reader.option("maxFilesPerTrigger", max_files)


def landing_files(spark: SparkSession, path: str, entity: str) -> DataFrame:
    """New payload files of one entity: (entity, imo, loaddate, raw)."""
    rows = (
        _limited(spark.readStream.format("text"))
        .option("wholetext", True)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", f"{entity}*.json")
        .load(path)
    )
    parsed = rows.select(*path_parts(F.col("_metadata.file_path")), F.col("value").alias("raw"))
    return parsed.filter(F.col("entity") == entity)


def landing_runs(spark: SparkSession, path: str, entity: str, after: str = "") -> DataFrame:
    """New payloads of one entity in the file layout, run by run: a start lists the runs that are new, not the zone."""
    landing_source.register(spark)
    return spark.readStream.format(landing_source.NAME).option("entity", entity).option("after", after).load(path)


def landing_bundles(spark: SparkSession, path: str, entity: str) -> DataFrame:
    """New payloads of one entity in the bundle layout."""
    rows = _limited(spark.readStream.schema(BUNDLE_SCHEMA)).json(path)
    return rows.filter(F.col("entity") == entity).select("entity", "imo", "loaddate", "raw")


def start_landing(payloads: DataFrame, sink: str, checkpoint: str, densify: bool = False,
                  trigger: dict | None = None) -> StreamingQuery:
    """Payload stream to a table of long rows; bad payloads are left out (see `start_quarantine`)."""
    good, _ = split_errors(payloads)
    return _to_table(timeseries_to_long(good, densify), sink, checkpoint, trigger)


def start_quarantine(payloads: DataFrame, sink: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """The payloads that `start_landing` leaves out, with status and error text."""
    return _to_table(split_errors(payloads)[1], sink, checkpoint, trigger)


def start_latest_wins(stream: DataFrame, target: str, checkpoint: str, order: list[str] | None = None,
                      trigger: dict | None = None) -> StreamingQuery:
    """Keep `target` (partitioned by `signal_date`) at the latest load of every point.

    A batch rewrites only the dates it has rows for, however late they are. Running a batch twice
    gives the same table, so a restart after a failure is safe; no watermark is needed. Rows without a
    time are a date of their own.
    """
    return _merge_by_date(stream, target, checkpoint, "signal_timestamp", trigger,
                          lambda stored, batch: latest_wins(combine([stored, batch]), order=order))


def start_first_seen(stream: DataFrame, target: str, checkpoint: str, keys: list[str],
                     time: str = "signal_timestamp", order: list[str] | None = None,
                     trigger: dict | None = None) -> StreamingQuery:
    """Keep `target` (partitioned by `signal_date`) at the first arrived row of every key.

    Stored rows come before those of the batch; within a batch `order` decides (default: loaddate, if
    there is one). A batch is reduced to one row per key on the map side and rewrites only the dates
    it has rows for, so a row may be as late as it likes.
    """
    ranking = order if order is not None else [c for c in ["loaddate"] if c in stream.columns]

    def merge(stored: DataFrame, batch: DataFrame) -> DataFrame:
        arrived = combine([stored.withColumn("_arrival", F.lit(0)), batch.withColumn("_arrival", F.lit(1))])
        return first_wins(arrived, keys, ["_arrival", *ranking]).drop("_arrival")

    return _merge_by_date(stream, target, checkpoint, time, trigger, merge)


def _merge_by_date(stream: DataFrame, target: str, checkpoint: str, time: str, trigger: dict | None,
                   merge: Callable[[DataFrame, DataFrame], DataFrame]) -> StreamingQuery:
    schema = T.StructType([*stream.schema.fields, T.StructField("signal_date", T.DateType())])

    def write(batch: DataFrame, _: int) -> None:
        dated = batch.withColumn("signal_date", F.to_date(time)).persist(StorageLevel.DISK_ONLY)
        try:
            # One value per day: bounded by the calendar.
            touched = [row.signal_date for row in dated.select("signal_date").distinct().collect()]
            if touched:
                stored = of_dates(read_table(batch.sparkSession, target, schema), "signal_date", touched)
                overwrite_partitions(merge(stored, dated), target, ["signal_date"])
        finally:
            dated.unpersist()

    writer = stream.writeStream.option("checkpointLocation", checkpoint).trigger(**(trigger or ONCE))
    return writer.foreachBatch(write).start()


def gap_session_rows(points: DataFrame, threshold: timedelta = GAP_THRESHOLD, late: timedelta = LATE_ROWS) -> DataFrame:
    """Gap intervals of a stream of null points, each emitted once it can no longer grow.

    The loaddate is that of the last point.
    """
    session = F.session_window("gap_start", _seconds(threshold))
    return (
        points.withWatermark("gap_start", _seconds(late))
        .groupBy(*SERIES, session.alias("session"))
        .agg(F.min("gap_start").alias("first"), F.max(F.struct("gap_start", "loaddate")).alias("last"))
        .select(*SERIES, F.col("first").alias("gap_start"), F.col("last.gap_start").alias("gap_end"), "last.loaddate")
    )


def start_gap_sessions(points: DataFrame, sink: str, checkpoint: str, threshold: timedelta = GAP_THRESHOLD,
                       late: timedelta = LATE_ROWS, trigger: dict | None = None,
                       state_partitions: int | None = None) -> StreamingQuery:
    """Sessions of a hot series are merged on the map side, so it reaches the state as few of them.

    Points later than `late` do not reach the sink: run `start_late_rows` on the same points beside it.
    """
    spark = points.sparkSession
    settings = {"spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
                # Fixed by the first start of a checkpoint: choose them for the stream's final size.
                "spark.sql.shuffle.partitions": str(state_partitions or spark.sparkContext.defaultParallelism)}
    with _settings(spark, settings):
        return _to_table(gap_session_rows(points, threshold, late), sink, checkpoint, trigger)


def start_late_rows(stream: DataFrame, side: str, checkpoint: str, time: str = "gap_start",
                    late: timedelta = LATE_ROWS, trigger: dict | None = None) -> StreamingQuery:
    """Rows that lie more than `late` behind the newest time seen so far, to a side table.

    These are at least the rows that a watermark of `late` drops from a stream over the same files.
    Each batch is a partition of its own (`batch`), so a repeated batch leaves the table as it was.
    """
    marks = f"{side.rstrip('/')}__newest"

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        known = read_table(spark, marks, "batch long, newest timestamp").filter(F.col("batch") < number)
        newest = [known.agg(F.max("newest")).first()[0], batch.agg(F.max(time)).first()[0]]
        newest = max((t for t in newest if t is not None), default=None)
        if newest is None:
            return
        behind = batch.filter(F.col(time) < F.lit(newest - late))
        replace_partition(behind, side, {"batch": str(number)})
        replace_partition(spark.createDataFrame([(newest,)], "newest timestamp"), marks, {"batch": str(number)})

    writer = stream.writeStream.option("checkpointLocation", checkpoint).trigger(**(trigger or ONCE))
    return writer.foreachBatch(write).start()


def merge_late_gaps(intervals: DataFrame, late_points: DataFrame, threshold: timedelta = GAP_THRESHOLD) -> DataFrame:
    """The batch job for late points: intervals of the stream with the side table merged in."""
    return merge_points(intervals, late_points, threshold)


def long_stream(spark: SparkSession, path: str, schema: T.StructType = schemas.LONG) -> DataFrame:
    """New files of a long table."""
    return _limited(spark.readStream.schema(schema)).parquet(path)


@contextmanager
def _settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings for the start of a query; afterwards they are as they were."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def _to_table(df: DataFrame, sink: str, checkpoint: str, trigger: dict | None) -> StreamingQuery:
    writer = df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or ONCE)).start(sink)


def _seconds(interval: timedelta) -> str:
    return f"{int(interval.total_seconds())} seconds"
