"""The scheduled jobs: landing zone to tables, daily summary, export and wide table.

All jobs work on all ships at once; `run` is the load stamp of a run (`yyyy/MM/dd/HH/mm`). Running a
job again for the same run gives the same tables.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetframe import schemas
from fleetframe.functions import run_time
from fleetframe.operators import dedup, enrich, gaps, nested, pivot, quality, statistics, summary, upsert
from fleetframe.session import materialize
from fleetframe.sources import jdbc, landing, runs, tables

# Landing entities (fixed values).
FLEET, SIGNALS, TIMESERIES = "ShipData", "Signals", "Timeseries"

RUN_COLUMNS = T.StructType([T.StructField("run_date", T.DateType()), T.StructField("run", T.StringType())])
POINTS = T.StructType([f for f in schemas.LONG.fields if f.name != "friendly_name"])
QUARANTINE = T.StructType([*schemas.LANDING.fields, T.StructField("status", T.StringType()),
                           T.StructField("detail", T.StringType())])
# One row per stored run, so that choosing runs does not open the measurements.
MANIFEST = T.StructType([T.StructField("rows", T.LongType()), *RUN_COLUMNS.fields])
# One row per date on which stored gaps start: the end of its last gap (at least), its gaps.
GAP_DATES = T.StructType([T.StructField("gap_date", T.DateType()), T.StructField("last_end", T.TimestampType()),
                          T.StructField("rows", T.LongType())])
ROLLED = T.StructType([T.StructField("day", T.StringType())])


class NoShipsError(RuntimeError):
    """The fleet payload of a run has no ships, so nothing was stored."""


@dataclass(frozen=True)
class Lake:
    """Where the tables are, and the settings of the deployment."""

    landing: str
    tables: str
    history_days: int = runs.HISTORY_DAYS
    days_to_keep: int = runs.DAYS_TO_KEEP
    gap_threshold: timedelta = field(default=gaps.GAP_THRESHOLD)
    bundled: bool = False
    # Types of ship fields by the majority of the ships; values of another kind go to `odd_values`.
    typed_by_majority: bool = False
    # The history window takes the last run per ship and day; True: only those of the day's last hour.
    last_hour_only: bool = False

    def path(self, name: str) -> str:
        return f"{self.tables.rstrip('/')}/{name}"


@dataclass(frozen=True)
class Run:
    """A run, by its load stamp."""

    loaddate: str

    @property
    def at(self) -> datetime:
        return datetime.strptime(self.loaddate, "%Y/%m/%d/%H/%M")

    @property
    def day(self) -> date:
        return self.at.date()

    @property
    def id(self) -> str:
        return self.at.strftime("%Y%m%d%H%M")


def payloads(spark: SparkSession, lake: Lake, run: Run, entity: str) -> DataFrame:
    """Payloads of one entity and run, in either landing layout."""
    if not lake.bundled:
        return landing.read_landing(spark, lake.landing, entity, run.loaddate)
    rows = landing.read_bundles(spark, lake.landing, entity, run.loaddate)
    return rows.drop("run_date")


def ingest_fleet(spark: SparkSession, lake: Lake, run: Run, ship_schema: T.StructType | str | None = None) -> None:
    """Ships with their child tables, active ships, signal definitions and the signal mapping.

    A run without ships (no payload, or an error answer) leaves all ship tables as they are and fails.
    """
    good, bad = quality.split_errors(payloads(spark, lake, run, FLEET))
    ships = materialize(nested.ships_of(good).filter(F.col("imo").isNotNull()))
    _quarantine(bad, lake, run, FLEET)
    if ships.isEmpty():
        raise NoShipsError(f"no ship data in run {run.loaddate}")
    tables.replace_table(nested.active_ships(ships), lake.path("active_ships"))
    if lake.typed_by_majority:
        fields = nested.variant_fields(ships)
        schema = nested.majority_schema(fields)
        rows = nested.ships_by_majority(ships, schema)
        _write_run(nested.odd_values(fields, schema), lake, "odd_values", run)
    else:
        rows = nested.unnest(nested.parse_ships(ships, ship_schema or nested.infer_ship_schema(ships)), "data")
    _write_run(nested.void_to_string(nested.main_table(rows)), lake, "ships", run)
    children = {f"ships_{name}": child for name, child in nested.child_tables(rows).items()}
    for name, child in children.items():
        _write_run(nested.void_to_string(child), lake, name, run)
    # Lists that an earlier attempt of this run had and this one lacks.
    for name in tables.table_names(spark, lake.tables, "ships_"):
        if name not in children:
            tables.drop_partition(spark, lake.path(name), _partition(run))
    ingest_signals(spark, lake, run)


def ingest_signals(spark: SparkSession, lake: Lake, run: Run) -> None:
    """Signal definitions of the active ships, and their readable names; the mapping only grows."""
    active = tables.read_table(spark, lake.path("active_ships"), schemas.SHIPS)
    mine = enrich.restrict_to_active(payloads(spark, lake, run, SIGNALS), active)
    good, bad = quality.split_errors(mine)
    _quarantine(bad, lake, run, SIGNALS)
    signals = materialize(nested.signals_to_rows(good).dropDuplicates(["imo", "signal"]))
    stored = tables.read_table(spark, lake.path("signals"), schemas.SIGNALS)
    tables.replace_table(upsert.merge_upsert(stored, signals, ["imo", "signal"]), lake.path("signals"))
    known = tables.read_table(spark, lake.path("signal_mapping"), schemas.MAPPING)
    tables.replace_table(enrich.update_mapping(known, signals), lake.path("signal_mapping"))


def long_rows(spark: SparkSession, lake: Lake, run: Run, ships: list[str] | None = None) -> DataFrame:
    """Long rows of a run, gaps included. Bad payloads and cells go to quarantine, counts to the audit."""
    active = tables.read_table(spark, lake.path("active_ships"), schemas.SHIPS)
    mine = enrich.restrict_to_active(payloads(spark, lake, run, TIMESERIES), active)
    if ships is not None:
        mine = mine.filter(F.col("imo").isin(ships))
    # The landing zone is read and classified once; status, cells and quarantine come from the staged rows.
    marked = materialize(quality.classify_payloads(mine))
    _write_run(quality.run_audit(marked), lake, "run_audit", run)
    _quarantine(marked.filter(F.col("status") != "ok"), lake, run, TIMESERIES)
    good = marked.filter(F.col("status") == "ok").drop("status", "detail")
    _write_run(nested.bad_cells(good), lake, "bad_cells", run)
    # A staging table, replaced by every run: measurements and gaps are both filtered scans of it.
    tables.write_table(nested.timeseries_to_long(good, densify=True, strict=True), lake.path("staging"), "overwrite")
    return tables.read_table(spark, lake.path("staging"), POINTS)


def ingest_timeseries(spark: SparkSession, lake: Lake, run: Run, ships: list[str] | None = None,
                      merge_history: bool = True) -> None:
    """Measurements of a run merged with the history window (latest load wins), and gap intervals."""
    rows = long_rows(spark, lake, run, ships)
    current = quality.measurements(rows)
    if merge_history:
        known = recent_runs(spark, lake, run)
        if lake.last_hour_only:
            history = runs.history_window(known, run.day, lake.history_days, before=run.at)
        else:
            history = runs.last_run_per_ship(known, run.day, lake.history_days, before=run.at)
        current = dedup.merge_history(history.select(*POINTS.fieldNames()), current)
    counted, counter = quality.observed(current, f"timeseries-{run.id}")
    _write_run(counted, lake, "timeseries", run)
    _write_run(statistics.run_sketches(stored_run(spark, lake, run), []), lake, "run_sketches", run)
    # The manifest row comes last: a run that is listed is complete.
    _write_run(spark.createDataFrame([(counter.get["rows"],)], "rows long"), lake, "runs", run)
    store_gaps(spark, lake, rows)


def stored_runs(spark: SparkSession, lake: Lake) -> DataFrame:
    """All stored runs of measurements, with `run_date`, `run` (partitions) and `run_ts`."""
    stored = tables.read_table(spark, lake.path("timeseries"), T.StructType([*POINTS.fields, *RUN_COLUMNS.fields]))
    return stored.withColumn("run_ts", F.to_timestamp("run", "yyyyMMddHHmm"))


def stored_run(spark: SparkSession, lake: Lake, run: Run) -> DataFrame:
    """The measurements of one run; its partition alone is read."""
    return stored_runs(spark, lake).filter((F.col("run_date") == F.lit(run.day)) & (F.col("run") == run.id))


def run_statistics(spark: SparkSession, lake: Lake, first: date, last: date) -> DataFrame:
    """Statistics over the runs of some days, from one row of sketches per run (see `operators.statistics`)."""
    sketches = tables.read_table(spark, lake.path("run_sketches"))
    chosen = sketches.filter((F.col("run_date") >= F.lit(first)) & (F.col("run_date") <= F.lit(last)))
    return statistics.estimates(statistics.merge_sketches(chosen))


def manifest(spark: SparkSession, lake: Lake) -> DataFrame:
    """(run_date, run, run_ts, rows): the stored runs that have rows, from one row per run."""
    listed = tables.read_table(spark, lake.path("runs"), MANIFEST).filter(F.col("rows") > 0)
    return listed.select("run_date", "run", F.to_timestamp("run", "yyyyMMddHHmm").alias("run_ts"), "rows")


def audit(spark: SparkSession, lake: Lake) -> DataFrame:
    """The audit rows of all runs."""
    return tables.read_table(spark, lake.path("run_audit"), T.StructType([*schemas.RUN_AUDIT.fields, *RUN_COLUMNS.fields]))


def run_list(stored: DataFrame) -> DataFrame:
    """The runs among stored rows. For a lake without manifest; jobs read `manifest`."""
    return stored.select("run_date", "run", "run_ts").distinct()


def only_runs(stored: DataFrame, chosen: DataFrame) -> DataFrame:
    """Rows of a few chosen runs. Their ids become a partition filter, so other runs are not read."""
    return stored.filter(F.col("run").isin([row.run for row in chosen.select("run").collect()]))


def recent_runs(spark: SparkSession, lake: Lake, run: Run) -> DataFrame:
    """Rows of the runs the history window can use: those of the recent days, or of each one's last hour."""
    oldest = run.day - timedelta(days=lake.history_days)
    recent = (F.col("run_date") > F.lit(oldest)) & (F.col("run_date") <= F.lit(run.day)) & (F.col("run_ts") < F.lit(run.at))
    known = manifest(spark, lake).filter(recent)
    if lake.last_hour_only:
        by_hour = known.withColumn("run_hour", F.date_trunc("hour", "run_ts"))
        last_hours = by_hour.groupBy("run_date").agg(F.max("run_hour").alias("run_hour"))
        known = by_hour.join(F.broadcast(last_hours), ["run_date", "run_hour"], "left_semi")
    return only_runs(stored_runs(spark, lake), known)


def store_gaps(spark: SparkSession, lake: Lake, rows: DataFrame) -> None:
    """Merge the gap intervals of a run into the stored ones, across runs and dates.

    A gap is stored with the date on which it starts; `gap_dates` has one row per date with the end of its last gap, so
    an interval that reaches into the run from an earlier date is found without reading the other dates. Only dates of
    gaps that change are rewritten; one that loses its last gap is removed.
    """
    found = materialize(gaps.gap_intervals(quality.gap_points(rows), lake.gap_threshold))
    reach = gaps.reach_of(found, lake.gap_threshold)
    if reach is None:
        return
    dates = tables.read_table(spark, lake.path("gap_dates"), GAP_DATES)
    near = dates.filter((F.col("last_end") >= reach[0]) & (F.col("gap_date") <= F.to_date(reach[1])))
    stored = tables.of_dates(stored_gaps(spark, lake), "gap_date", [row.gap_date for row in near.collect()])
    gone, new = (df.withColumn("gap_date", F.to_date("gap_start")) for df in gaps.changed_gaps(stored, found, lake.gap_threshold))
    # Days: bounded by the calendar.
    days = [row.gap_date for row in gone.select("gap_date").union(new.select("gap_date")).distinct().collect()]
    if not days:
        return
    of_days = tables.of_dates(stored_gaps(spark, lake), "gap_date", days)
    kept = materialize(gaps.without_gaps(of_days, gone).unionByName(new))
    _store_gap_dates(spark, lake, dates, kept, days)
    tables.overwrite_partitions(kept, lake.path("gaps"), ["gap_date"], emptied=[{"gap_date": day.isoformat()} for day in days])


def stored_gaps(spark: SparkSession, lake: Lake) -> DataFrame:
    """All stored gaps, with `gap_date` (partition)."""
    return tables.read_table(spark, lake.path("gaps"), T.StructType([*schemas.GAPS.fields, T.StructField("gap_date", T.DateType())]))


def _store_gap_dates(spark: SparkSession, lake: Lake, dates: DataFrame, kept: DataFrame, days: list[date]) -> None:
    """Written before the gaps: an end is never earlier than that of a stored gap, whatever is interrupted."""
    counted = kept.groupBy("gap_date").agg(F.max("gap_end").alias("last_end"), F.count(F.lit(1)).alias("rows"))
    listed = spark.createDataFrame([(day,) for day in days], "gap_date date").join(counted, "gap_date", "left").fillna(0, "rows")
    both = dates.withColumn("known", F.lit(True)).unionByName(listed.withColumn("known", F.lit(False)))
    grown = both.groupBy("gap_date").agg(F.max("last_end").alias("last_end"), F.min_by("rows", "known").alias("rows"))
    tables.replace_table(grown.select(*GAP_DATES.fieldNames()).coalesce(1), lake.path("gap_dates"))


def ingest_daily(spark: SparkSession, lake: Lake, run: Run) -> DataFrame:
    """Daily summary: rows of today that the reference window does not know. Returns the new ones."""
    rows = long_rows(spark, lake, run)
    mapping = tables.read_table(spark, lake.path("signal_mapping"), schemas.MAPPING)
    new = enrich.enrich_per_ship(quality.measurements(rows), mapping)
    cutoff = quality.cutoff_day(run.day, lake.history_days)
    reference = tables.read_table(spark, lake.path("ref_data"), schemas.TAGGED)
    today = summary_of(spark, lake, run.day)
    # The day of the last rollover is recorded: the first run of a day may fail or add nothing, and repeat.
    day = run.day.strftime("%Y%m%d")
    rolled = {row.day for row in tables.read_table(spark, lake.path("ref_rollover"), ROLLED).collect()}
    if today.isEmpty() and day not in rolled:
        yesterday = summary_of(spark, lake, run.day - timedelta(days=1))
        # Equal rows are those of an interrupted attempt: a summary holds each key once.
        tables.replace_table(summary.rollover(reference, yesterday, cutoff).distinct(), lake.path("ref_data"))
        tables.replace_table(spark.createDataFrame([(day,)], ROLLED), lake.path("ref_rollover"))
        reference = tables.read_table(spark, lake.path("ref_data"), schemas.TAGGED)
    else:
        reference = quality.within_history(reference, cutoff)
    first = materialize(summary.first_seen(summary.tag_sources(reference, today, new)))
    kept = summary.summary_columns(quality.by_tag(first, "today", "new"))
    dated = kept.withColumn("summary_date", F.lit(run.day.strftime("%Y%m%d")))
    tables.overwrite_partitions(dated, lake.path("daily_summary"), ["summary_date"], rebalance=False)
    tables.replace_table(kept, lake.path("timeseries_today"))
    store_gaps(spark, lake, rows)
    return summary.summary_columns(quality.by_tag(first, "new"))


def summary_of(spark: SparkSession, lake: Lake, day: date) -> DataFrame:
    """The stored summary of one day."""
    rows = tables.read_summaries(spark, lake.path("daily_summary"), day.strftime("%Y%m%d"), schemas.LONG)
    return rows.drop("summary_date")


def reenrich_summaries(spark: SparkSession, lake: Lake, pattern: str) -> None:
    """Backfill: attach the current signal names to stored summaries whose date matches `pattern`."""
    mapping = tables.read_table(spark, lake.path("signal_mapping"), schemas.MAPPING)
    rows = tables.read_summaries(spark, lake.path("daily_summary"), pattern, schemas.LONG)
    tables.overwrite_partitions(enrich.reenrich(rows, mapping), lake.path("daily_summary"), ["summary_date"])


def export_pivot(spark: SparkSession, lake: Lake, output: str, max_days: int | None = None,
                 max_signals: int | None = None) -> DataFrame:
    """Wide table of the last run of each day; returns its statistics."""
    chosen = runs.latest_run_per_day(manifest(spark, lake), max_days)
    rows = quality.measurements(only_runs(stored_runs(spark, lake), chosen))
    if max_signals is None:
        # The names become a filter of the scan, before the deduplication.
        signals, latest = pivot.signal_list(rows), dedup.latest_wins(rows)
    else:
        latest = materialize(dedup.latest_wins(rows))
        signals = [row.signal for row in pivot.top_signals(latest, max_signals).collect()]
    tables.export_pivot(pivot.pivot_long(latest, signals, unique=True), output)
    return pivot.pivot_stats(spark.read.parquet(output))


def load_gold(spark: SparkSession, lake: Lake, run: Run, url: str | None = None, **jdbc_options) -> None:
    """Upsert a run into the wide table; only the days the run has rows for are rewritten.

    With the `url` of a database the run's wide rows (for the merge there) and the definitions go there too.
    """
    rows = stored_run(spark, lake, run)
    latest = dedup.latest_wins(quality.measurements(rows))
    loaded = materialize(pivot.pivot_latest(latest, pivot.signal_list(rows)))
    dated = loaded.withColumn("signal_date", F.to_date("signal_timestamp"))
    days = [row.signal_date for row in dated.select("signal_date").distinct().collect()]
    stored = tables.of_dates(gold(spark, lake), "signal_date", days)
    merged = upsert.pivot_upsert(stored, dated, [*schemas.PIVOT_KEY, "signal_date"], staged=True)
    _add_columns(spark, lake, [c for c in loaded.columns if c not in schemas.PIVOT.fieldNames()])
    tables.overwrite_partitions(merged, lake.path("gold"), ["signal_date"])
    tables.replace_table(definitions(spark, lake), lake.path("gold_signals"))
    if url is not None:
        jdbc.write_jdbc(loaded, url, "gold_load", **jdbc_options)
        jdbc.write_jdbc(definitions(spark, lake), url, "gold_signals", if_exists="replace", **jdbc_options)


def definitions(spark: SparkSession, lake: Lake) -> DataFrame:
    """The name step of the wide table: one definition per signal, that of the first ship."""
    stored = tables.read_table(spark, lake.path("signals"), schemas.SIGNALS)
    return nested.catalog_columns(enrich.catalog_first_wins(stored, ["imo"]))


def gold(spark: SparkSession, lake: Lake) -> DataFrame:
    """The wide table with all signal columns seen so far."""
    names = sorted(row.signal for row in _columns(spark, lake).select("signal").distinct().collect())
    signals = [T.StructField(name, T.DoubleType()) for name in names]
    schema = T.StructType([*schemas.PIVOT.fields, *signals, T.StructField("signal_date", T.DateType())])
    return tables.read_table(spark, lake.path("gold"), schema)


def _columns(spark: SparkSession, lake: Lake) -> DataFrame:
    return tables.read_table(spark, lake.path("gold_columns"), T.StructType([T.StructField("signal", T.StringType())]))


def _add_columns(spark: SparkSession, lake: Lake, names: list[str]) -> None:
    known = {row.signal for row in _columns(spark, lake).distinct().collect()}
    added = [(name,) for name in names if name not in known]
    if added:
        tables.append_table(spark.createDataFrame(added, "signal string"), lake.path("gold_columns"))


def expired_runs(spark: SparkSession, lake: Lake, as_of: date) -> DataFrame:
    """Dry run of the retention: the days that would go, with their row counts."""
    return runs.expired(stored_runs(spark, lake), as_of, lake.days_to_keep)


def expired(spark: SparkSession, lake: Lake, as_of: date) -> DataFrame:
    """Dry run of the retention for all layers: (layer, run_date, row_count) of what would go.

    Rows come from the manifest of runs and the list of gap dates; of the landing zone the files are listed and counted.
    Neither measurements nor payloads are read.
    """
    if lake.bundled:
        landed = landing.bundle_dates(spark, lake.landing)
    else:
        listed = landing.list_files(spark, lake.landing, "*.json")
        landed = listed.groupBy(F.to_date(run_time("loaddate")).alias("run_date")).agg(F.count(F.lit(1)).alias("rows"))
    gap_days = tables.read_table(spark, lake.path("gap_dates"), GAP_DATES).select(F.col("gap_date").alias("run_date"), "rows")
    layers = {"landing": landed, "timeseries": manifest(spark, lake).select("run_date", "rows"), "gaps": gap_days}
    old = F.col("run_date") < F.date_sub(F.lit(as_of), lake.days_to_keep)
    found = [df.filter(old & (F.col("rows") > 0)).groupBy(F.lit(name).alias("layer"), "run_date").agg(F.sum("rows").alias("row_count"))
             for name, df in layers.items()]
    return dedup.combine(found)


MODES = ("all", "fleet", "timeseries")


def run_jobs(spark: SparkSession, lake: Lake, loaddate: str, mode: str = "all", daily: bool = False) -> DataFrame:
    """One scheduled run: `all`, `fleet` (ships and signals) or `timeseries`. Returns what has expired by then."""
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    run = Run(loaddate)
    if mode in ("all", "fleet"):
        ingest_fleet(spark, lake, run)
    if mode in ("all", "timeseries"):
        if daily:
            ingest_daily(spark, lake, run)
        else:
            ingest_timeseries(spark, lake, run)
    return expired(spark, lake, run.day)


def _partition(run: Run) -> dict[str, str]:
    return {"run_date": run.day.isoformat(), "run": run.id}


def _write_run(df: DataFrame, lake: Lake, name: str, run: Run) -> None:
    """Replace the rows of a run, also by none."""
    tables.replace_partition(df, lake.path(name), _partition(run))


def _quarantine(bad: DataFrame, lake: Lake, run: Run, entity: str) -> None:
    rows = bad.select(*QUARANTINE.fieldNames())
    tables.replace_partition(rows, lake.path("quarantine"), _partition(run) | {"entity": entity})
