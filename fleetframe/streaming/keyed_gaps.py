"""Gap intervals of a stream of null points as keyed state: late points change intervals that are already out.

Every series keeps its intervals as state. A batch merges its points into them and emits what changed: `put` rows carry a
new interval or a new form of one, `remove` rows the start of one that another has taken in. Before they are moved to
their series, points are reduced to one row per time slot (see `operators.gaps`), batch by batch where they are read, so
a hot series arrives as few rows. Timers forget intervals that ended longer ago than points may be late.

The state lies by bucket of series: a call to the state store costs milliseconds whatever it carries, so series share theirs.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from datetime import timedelta

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from fleetframe.functions import to_us
from fleetframe.operators.gaps import GAP_THRESHOLD, SERIES, without_gaps
from fleetframe.session import materialize, ship
from fleetframe.sources.runs import DAYS_TO_KEEP
from fleetframe.sources.tables import of_dates, overwrite_partitions, read_table
from fleetframe.streaming.streams import ONCE, _settings

# Later points concern days that retention removes.
LATE = timedelta(days=DAYS_TO_KEEP)

SLOTS = "imo string, signal string, first long, last long, loaddate string, at timestamp"
STATE = "imo string, signal string, gap_start long, gap_end long, loaddate string"
CHANGES = "imo string, signal string, gap_start timestamp, gap_end timestamp, loaddate string, change string"
INTERVALS = "imo string, signal string, gap_start timestamp, gap_end timestamp, loaddate string, gap_date date"

# Buckets of series. Fixed by the first start of a checkpoint, since the state is kept by them.
BUCKETS = 4096

Interval = tuple[int, int, str | None]
Series = tuple[str | None, str | None]


def slots_of(points: DataFrame, threshold: timedelta = GAP_THRESHOLD) -> DataFrame:
    """(imo, signal, first, last, loaddate, at): one row per occupied slot of each batch of rows, times in microseconds.

    `loaddate` is that of the last point, the greatest of equal ones. Points without a time are left out.
    """
    width = to_us(threshold)

    def reduce(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            ordered = rows.assign(slot=rows["micros"] // width).sort_values(["micros", "loaddate"], na_position="first")
            first = ordered.groupby([*SERIES, "slot"], dropna=False, sort=False)["micros"].transform("first")
            made = ordered.assign(first=first).drop_duplicates([*SERIES, "slot"], keep="last").rename(columns={"micros": "last"})
            made = made.assign(at=pd.to_datetime(made["last"], unit="us", utc=True))
            yield made[[*SERIES, "first", "last", "loaddate", "at"]]

    timed = points.filter(F.col("gap_start").isNotNull())
    rows = timed.select(*SERIES, F.unix_micros("gap_start").alias("micros"), "loaddate")
    return rows.mapInPandas(reduce, SLOTS)


def merged(stored: list[Interval], found: list[Interval], threshold: int) -> list[Interval]:
    """Intervals at most `threshold` apart are one; it has the stamp of its last point, the greatest of equal ones."""
    made: list[Interval] = []
    for start, end, stamp in sorted([*stored, *found], key=lambda x: (x[0], x[1], x[2] or "")):
        if made and start - made[-1][1] <= threshold:
            begin, last, known = made[-1]
            if (end, stamp or "") > (last, known or ""):
                last, known = end, stamp
            made[-1] = begin, last, known
        else:
            made.append((start, end, stamp))
    return made


class GapState(StatefulProcessor):
    """The intervals of the series of one bucket, those that points may still reach."""

    def __init__(self, threshold: int, late: int):
        self.threshold, self.late = threshold, late

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.intervals = handle.getListState("intervals", STATE)

    def handleInputRows(self, key, rows, timerValues):  # noqa: N802, N803
        found: dict[Series, list[Interval]] = defaultdict(list)
        for part in rows:
            for imo, signal, *interval in _tuples(part[[*SERIES, "first", "last", "loaddate"]]):
                found[imo, signal].append(tuple(interval))
        stored = self._stored()
        changes, changed = [], False
        for series, points in found.items():
            known = stored.get(series, [])
            now = merged(known, points, self.threshold)
            before, after = set(known), set(now)
            if after != before:
                starts = {start for start, _, _ in now}
                changes += [(*series, *x, "put") for x in now if x not in before]
                changes += [(*series, *x, "remove") for x in known if x not in after and x[0] not in starts]
                stored[series], changed = now, True
        if changed:
            self._keep(stored)
        yield self._rows(changes)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):  # noqa: N802, N803
        passed = timerValues.getCurrentWatermarkInMs() * 1000 - self.threshold
        kept = {series: [x for x in known if x[1] >= passed] for series, known in self._stored().items()}
        self._keep({series: known for series, known in kept.items() if known})
        yield self._rows([])

    def _stored(self) -> dict[Series, list[Interval]]:
        stored: dict[Series, list[Interval]] = defaultdict(list)
        if self.intervals.exists():
            for row in self.intervals.get():
                stored[row[0], row[1]].append((row[2], row[3], row[4]))
        return stored

    def _keep(self, stored: dict[Series, list[Interval]]) -> None:
        """Store the intervals; one timer per bucket, for when the watermark has passed what can reach the first end."""
        rows = [(*series, *x) for series, known in stored.items() for x in known]
        for known in list(self.handle.listTimers()):
            self.handle.deleteTimer(known)
        if rows:
            self.intervals.put(rows)
            self.handle.registerTimer((min(row[3] for row in rows) + self.threshold) // 1000 + 1)
        else:
            self.intervals.clear()

    @staticmethod
    def _rows(changes: list) -> pd.DataFrame:
        made = pd.DataFrame(changes, columns=[*SERIES, "gap_start", "gap_end", "loaddate", "change"], dtype=object)
        for column in ("gap_start", "gap_end"):
            made[column] = pd.to_datetime(made[column].astype("int64"), unit="us", utc=True)
        return made

    def close(self) -> None:
        pass


def _tuples(rows: pd.DataFrame) -> Iterator[tuple]:
    """Rows as tuples of Python values, null as None."""
    columns = [rows[c].astype(object).where(rows[c].notna(), None).tolist() for c in rows.columns]
    return zip(*columns, strict=True)


def gap_changes(points: DataFrame, threshold: timedelta = GAP_THRESHOLD, late: timedelta = LATE) -> DataFrame:
    """The changes of the gap intervals of a stream of null points (see the module)."""
    ship(points.sparkSession)
    slots = slots_of(points, threshold).withWatermark("at", f"{int(late.total_seconds())} seconds")
    state = GapState(to_us(threshold), to_us(late))
    placed = slots.withColumn("bucket", F.pmod(F.xxhash64(*SERIES), F.lit(BUCKETS)))
    return placed.groupBy("bucket").transformWithStateInPandas(state, CHANGES, "Update", "EventTime")


def apply_changes(stored: DataFrame, changes: DataFrame) -> DataFrame:
    """Stored intervals after the changes of a batch, at most one per series and start."""
    return without_gaps(stored, changes).unionByName(changes.filter(F.col("change") == "put").drop("change"))


def start_gaps(points: DataFrame, target: str, checkpoint: str, threshold: timedelta = GAP_THRESHOLD, late: timedelta = LATE,
               trigger: dict | None = None, state_partitions: int | None = None) -> StreamingQuery:
    """Keep `target` (partitioned by `gap_date`, the date of the start) at the gap intervals of all points so far.

    Points may come in any order, up to `late` behind the newest; they extend or join intervals that are already stored. A
    batch rewrites only the dates of intervals that changed. Repeating a batch gives the same table. Points that are later
    still do not arrive; `start_late_rows` on the same points keeps them.
    """
    spark = points.sparkSession

    def write(batch: DataFrame, _: int) -> None:
        changes = materialize(batch.withColumn("gap_date", F.to_date("gap_start")))
        # Days: bounded by the calendar.
        days = [row.gap_date for row in changes.select("gap_date").distinct().collect()]
        if days:
            stored = of_dates(read_table(batch.sparkSession, target, INTERVALS), "gap_date", days)
            overwrite_partitions(apply_changes(stored, changes), target, ["gap_date"],
                                 emptied=[{"gap_date": day.isoformat()} for day in days])

    settings = {"spark.sql.shuffle.partitions": str(state_partitions or spark.sparkContext.defaultParallelism),
                "spark.sql.streaming.stateStore.providerClass":
                    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}
    with _settings(spark, settings):
        writer = gap_changes(points, threshold, late).writeStream.option("checkpointLocation", checkpoint)
        return writer.outputMode("update").trigger(**(trigger or ONCE)).foreachBatch(write).start()
