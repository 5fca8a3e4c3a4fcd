"""Null measurements merged into gap intervals.

A series with very many null points must not end in one task. Points are first reduced to one row
per (series, time slot), the slot being as wide as the threshold: two points of a slot are closer
than the threshold, hence in the same gap, so the reduction is exact. It combines on the map side.
What is left of a series is bounded by its time span divided by the threshold, however many rows
it had, and only that is ordered in time.
"""

from __future__ import annotations

from datetime import timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetframe import scale
from fleetframe.functions import distance_us, slot_of, to_us
from fleetframe.session import materialize

# Greatest distance of two points of one gap (fixed values): the default and the finer variant.
GAP_THRESHOLD = timedelta(minutes=15)
FINE_GAP_THRESHOLD = timedelta(minutes=5)

SERIES = ["imo", "signal"]
GAP_KEY = ["imo", "signal", "gap_start"]


def _slots(points: DataFrame, threshold: timedelta) -> DataFrame:
    """(imo, signal, first, last, loaddate): occupied slots; loaddate is that of the last point."""
    if threshold <= timedelta(0):
        raise ValueError("the threshold of a gap must be positive")
    timed = points.filter(F.col("gap_start").isNotNull())
    slots = timed.groupBy(*SERIES, slot_of("gap_start", threshold).alias("slot")).agg(
        F.min("gap_start").alias("first"),
        F.max(F.struct("gap_start", "loaddate")).alias("z"),
    )
    return slots.select(*SERIES, "first", F.col("z.gap_start").alias("last"), F.col("z.loaddate").alias("loaddate"))


def gap_intervals(points: DataFrame, threshold: timedelta = GAP_THRESHOLD) -> DataFrame:
    """Gap intervals per series: points at most `threshold` apart belong to one gap.

    `gap_end` is the last null point, the loaddate is that point's.
    """
    by_time = Window.partitionBy(*SERIES).orderBy("first")
    so_far = by_time.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    wide = to_us(threshold)
    before, after = F.lag("last").over(by_time), F.lead("first").over(by_time)
    edges = _slots(points, threshold).withColumns({
        "opens": before.isNull() | (distance_us(F.col("first"), before) > wide),
        "closes": after.isNull() | (distance_us(after, F.col("last")) > wide),
    })
    # Starts grow with time, so the newest start so far is that of the current gap. The slot that
    # closes a gap then holds all of its columns: no aggregation is needed.
    started = edges.withColumn("gap_start", F.max(F.when(F.col("opens"), F.col("first"))).over(so_far))
    return started.filter("closes").select(*SERIES, "gap_start", F.col("last").alias("gap_end"), "loaddate")


def gap_sessions(points: DataFrame, threshold: timedelta = GAP_THRESHOLD) -> DataFrame:
    """The same intervals written as session windows (a slot lasts until its last point + threshold)."""
    slots = _slots(points, threshold)
    length = distance_us(F.col("last"), F.col("first")) + to_us(threshold)
    # The interval is built from microseconds as a decimal: a double would lose exactness.
    seconds = (length.cast("decimal(20,0)") / F.lit(1_000_000)).cast("decimal(18,6)")
    session = F.session_window("first", F.make_interval(secs=seconds))
    return (
        slots.groupBy(*SERIES, session.alias("session"))
        .agg(
            F.min("first").alias("gap_start"),
            F.max("last").alias("gap_end"),
            F.max_by("loaddate", "last").alias("loaddate"),
        )
        .drop("session")
    )


def _islands(intervals: DataFrame, threshold: timedelta) -> DataFrame:
    """`intervals` with what they are part of once those at most `threshold` apart are one.

    `opens` marks the first of each island; `start`, `end` and `stamp` are those of the island, the stamp the first that
    reported its end. Intervals of a series are ordered in one task: as they come from `gap_intervals` or are stored, their
    number is bounded by the time span, not by points.
    """
    by_time = Window.partitionBy(*SERIES).orderBy("gap_start", "gap_end", "loaddate")
    ended = F.max("gap_end").over(by_time.rowsBetween(Window.unboundedPreceding, -1))
    opens = ended.isNull() | (distance_us(F.col("gap_start"), ended) > to_us(threshold))
    island = F.sum(F.col("opens").cast("int")).over(by_time.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    of_island = Window.partitionBy(*SERIES, "island")
    numbered = intervals.withColumn("opens", opens).withColumn("island", island).withColumns({
        "start": F.min("gap_start").over(of_island), "end": F.max("gap_end").over(of_island)})
    return numbered.withColumn("stamp", F.min(F.when(F.col("gap_end") == F.col("end"), F.col("loaddate"))).over(of_island))


def _merged(islands: DataFrame) -> DataFrame:
    return islands.filter("opens").select(
        *SERIES, F.col("start").alias("gap_start"), F.col("end").alias("gap_end"), F.col("stamp").alias("loaddate"))


def merge_intervals(intervals: DataFrame, threshold: timedelta = GAP_THRESHOLD) -> DataFrame:
    """Intervals of which those at most `threshold` apart, overlapping or nested are one, as gaps of their points are."""
    return _merged(_islands(intervals, threshold))


def reach_of(gaps: DataFrame, threshold: timedelta = GAP_THRESHOLD) -> tuple[Column, Column] | None:
    """The time in which other gaps can touch these, as two literals; None without gaps."""
    low, high = gaps.agg(F.unix_micros(F.min("gap_start")), F.unix_micros(F.max("gap_end"))).first()
    if low is None:
        return None
    return F.timestamp_micros(F.lit(low - to_us(threshold))), F.timestamp_micros(F.lit(high + to_us(threshold)))


def touching(table: DataFrame, gaps: DataFrame, threshold: timedelta = GAP_THRESHOLD) -> DataFrame:
    """Stored gaps of the series of `gaps` in the time they span; only these can change.

    The two bounds of the time are literals, so they reach the scan.
    """
    reach = reach_of(gaps, threshold)
    if reach is None:
        return table.limit(0)
    near = table.filter((F.col("gap_end") >= reach[0]) & (F.col("gap_start") <= reach[1]))
    # A series without ship or signal is one too; joins do not match its keys.
    nameless = reduce(Column.__or__, [F.col(c).isNull() for c in SERIES])
    return scale.semi_join(near.filter(~nameless), gaps.select(*SERIES).distinct(), SERIES).unionByName(near.filter(nameless))


def changed_gaps(table: DataFrame, gaps: DataFrame, threshold: timedelta = GAP_THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """(gone, new): the stored gaps that newly found ones extend or join, and what takes their place.

    A stored gap that already holds the found ones is in neither. Both read one materialized frame.
    """
    columns = [*GAP_KEY, "gap_end", "loaddate"]
    near = touching(table.select(*columns), gaps, threshold).withColumn("stored", F.lit(True))
    both = _islands(near.unionByName(gaps.select(*columns).withColumn("stored", F.lit(False))), threshold)
    same = (F.col("stored") & (F.col("gap_start") == F.col("start")) & (F.col("gap_end") == F.col("end"))
            & F.col("loaddate").eqNullSafe(F.col("stamp")))
    stays = F.max(same).over(Window.partitionBy(*SERIES, "island"))
    changed = materialize(both.withColumn("stays", stays).filter("NOT stays"))
    return changed.filter("stored").select(*columns), _merged(changed)


def append_gaps(table: DataFrame, gaps: DataFrame, threshold: timedelta = GAP_THRESHOLD) -> DataFrame:
    """Stored gaps with newly found ones merged in: the gaps of all their points. The same gaps again change nothing.

    Gaps of the table are unique by series and start.
    """
    gone, new = changed_gaps(table, gaps, threshold)
    return without_gaps(table.select(*new.columns), gone).unionByName(new)


def without_gaps(table: DataFrame, gone: DataFrame) -> DataFrame:
    """The gaps of a table that are not among `gone`, by series and start; the table is not shuffled for a short list."""
    keys = gone.select(*[F.col(c).alias(f"_{c}") for c in GAP_KEY])
    listed = F.broadcast(keys) if scale.fits_broadcast(keys) else keys
    same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in GAP_KEY])
    return table.join(listed, same, "left_anti")


def merge_points(intervals: DataFrame, points: DataFrame, threshold: timedelta = GAP_THRESHOLD) -> DataFrame:
    """Intervals after further null points came in: points may extend intervals or join two of them.

    Only series with new points are merged again; the others pass.
    """
    return append_gaps(intervals, materialize(gap_intervals(points, threshold)), threshold)
