"""Every registered query: a DataFrame builder over the whole tables and its SQL counterpart."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetframe import oracle, views
from fleetframe.functions import loaddate_of
from fleetframe.operators import dedup, enrich, gaps, nested, pivot, quality, statistics, summary, upsert
from fleetframe.plans import jobs
from fleetframe.session import materialize, use_utc, work_path
from fleetframe.sources import landing, runs, tables
from fleetframe.streaming import replay

Builder = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Builder] = {}
SQL: dict[str, str] = {}

AS_OF = date(2024, 1, 30)
LONG = "imo, signal, signal_timestamp, signal_value, loaddate, event_id"
SIGNALS = ["friendly_name", "unit", "object_code", "name_code", "group_name", "sub_group"]


def query(name: str, sql: str | None = None, *needs: str) -> Callable[[Builder], Builder]:
    def register(build: Builder) -> Builder:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(use_utc(spark), sf_dir)

        QUERIES[name] = run
        if sql is not None:
            SQL[name] = oracle.with_views(sql, *needs)
        return run

    return register


# --- filters, deduplication, unions ------------------------------------------------------------


@query("measurements", f"SELECT {LONG} FROM measured", "measured")
def _(spark, sf_dir):
    return quality.measurements(views.tele(spark, sf_dir))


@query("gap_points", "SELECT imo, signal, signal_timestamp, loaddate, signal_timestamp AS gap_start FROM nulls", "nulls")
def _(spark, sf_dir):
    return quality.gap_points(views.tele(spark, sf_dir))


@query("history_cutoff", f"SELECT {LONG} FROM tele WHERE substr(loaddate, 1, 10) > '2024/01/25'", "tele")
def _(spark, sf_dir):
    cutoff = quality.cutoff_day(AS_OF, runs.HISTORY_DAYS)
    return quality.within_history(views.tele(spark, sf_dir), cutoff)


def latest(spark, sf_dir):
    return dedup.latest_wins(quality.measurements(views.tele(spark, sf_dir)), order=views.TIE_BREAK)


@query("latest_wins", f"SELECT {LONG} FROM latest", "latest")
def _(spark, sf_dir):
    return latest(spark, sf_dir)


HISTORY_DAY, CURRENT_DAY = "2024-01-21", "2024-01-16"


def overlapping_loads(spark, sf_dir):
    rows = quality.measurements(views.tele(spark, sf_dir))
    history = rows.filter(F.col("signal_timestamp") < F.lit(HISTORY_DAY).cast("timestamp"))
    current = rows.filter(F.col("signal_timestamp") >= F.lit(CURRENT_DAY).cast("timestamp"))
    return history, current


OVERLAP = f"""WITH both_loads AS (
    SELECT * FROM measured WHERE signal_timestamp < TIMESTAMP '{HISTORY_DAY}'
    UNION ALL SELECT * FROM measured WHERE signal_timestamp >= TIMESTAMP '{CURRENT_DAY}')
    SELECT {LONG} FROM both_loads"""


@query("combine_runs", OVERLAP, "measured")
def _(spark, sf_dir):
    return dedup.combine(list(overlapping_loads(spark, sf_dir)))


@query("merge_history", OVERLAP + """ QUALIFY row_number() OVER (PARTITION BY imo, signal, signal_timestamp
    ORDER BY loaddate DESC, event_id DESC) = 1""", "measured")
def _(spark, sf_dir):
    return dedup.merge_history(*overlapping_loads(spark, sf_dir), order=views.TIE_BREAK)


@query("stage_counts", """SELECT CAST((SELECT count(*) FROM tele) AS BIGINT) AS loaded,
    CAST((SELECT count(*) FROM measured) AS BIGINT) AS non_null,
    CAST((SELECT count(*) FROM latest) AS BIGINT) AS deduplicated""", "latest")
def _(spark, sf_dir):
    return quality.stage_counts(views.tele(spark, sf_dir), dedup.POINT_KEY)


# --- names and ships ---------------------------------------------------------------------------


@query("enrich_global", f"""SELECT {LONG}, friendly_name FROM measured LEFT JOIN (
    SELECT DISTINCT signal, friendly_name FROM catalog WHERE friendly_name IS NOT NULL) USING (signal)""",
       "measured", "catalog")
def _(spark, sf_dir):
    return enrich.enrich_global(quality.measurements(views.tele(spark, sf_dir)), views.stored_catalog(spark, sf_dir))


PER_SHIP = """SELECT imo, signal, friendly_name, signal_timestamp, signal_value, loaddate, event_id FROM {rows}
    LEFT JOIN (SELECT imo, signal, friendly_name FROM catalog WHERE friendly_name IS NOT NULL) USING (imo, signal)"""


@query("enrich_per_ship", PER_SHIP.format(rows="measured"), "measured", "catalog")
def _(spark, sf_dir):
    return enrich.enrich_per_ship(quality.measurements(views.tele(spark, sf_dir)), views.stored_catalog(spark, sf_dir))


@query("reenrich_backfill", PER_SHIP.format(rows="latest"), "latest", "catalog")
def _(spark, sf_dir):
    stored = latest(spark, sf_dir).withColumn("friendly_name", F.lit("outdated"))
    return enrich.reenrich(stored, views.stored_catalog(spark, sf_dir))


@query("mapping_distinct", """SELECT imo, signal, friendly_name FROM catalog UNION
    SELECT imo, signal, 'old ' || signal FROM catalog WHERE signal < 'p'""", "catalog")
def _(spark, sf_dir):
    known = views.catalog(spark, sf_dir).filter(F.col("signal") < "p")
    renamed = known.withColumn("friendly_name", F.concat(F.lit("old "), F.col("signal")))
    return enrich.update_mapping(dedup.combine([known, renamed]), views.catalog(spark, sf_dir))


@query("catalog_first_wins", f"""SELECT signal, {', '.join(SIGNALS)} FROM signals
    QUALIFY row_number() OVER (PARTITION BY signal ORDER BY imo) = 1""", "signals")
def _(spark, sf_dir):
    signals = nested.signals_to_rows(views.signal_payloads(spark, sf_dir))
    return nested.catalog_columns(enrich.catalog_first_wins(signals, ["imo"]))


@query("active_entities", "SELECT imo FROM ships WHERE is_active", "ships")
def _(spark, sf_dir):
    return nested.active_ships(nested.ships_of(views.fleet_payloads(spark, sf_dir)))


@query("restrict_active", f"SELECT {LONG} FROM tele WHERE imo IN (SELECT imo FROM ships WHERE is_active)",
       "tele", "ships")
def _(spark, sf_dir):
    active = nested.active_ships(nested.ships_of(views.fleet_payloads(spark, sf_dir)))
    return enrich.restrict_to_active(views.tele(spark, sf_dir), active)


# --- nested payloads ---------------------------------------------------------------------------


def fleet(spark, sf_dir):
    return nested.parse_ships(nested.ships_of(views.fleet_payloads(spark, sf_dir)), views.FLEET_SHIP)


@query("unnest_struct", """SELECT imo, active, c_name AS name, c_mktsegment AS segment, c_acctbal AS acctbal,
    n_name AS nation, r_name AS region_name, loaddate FROM ships""", "ships")
def _(spark, sf_dir):
    lifted = nested.unnest(nested.unnest(nested.unnest(fleet(spark, sf_dir), "data"), "home"), "region")
    return lifted.drop("main_engines", "aux_engines", "tags")


@query("main_without_lists", """SELECT imo, active, c_name AS name, c_mktsegment AS segment, c_acctbal AS acctbal,
    n_name AS home_nation, r_name AS home_region, loaddate FROM ships""", "ships")
def _(spark, sf_dir):
    main = nested.main_table(nested.unnest(fleet(spark, sf_dir), "data"))
    flat = main.withColumns({"home_nation": F.col("home.nation"), "home_region": F.col("home.region.region_name")})
    return flat.drop("home")


@query("flatten_structs", """SELECT imo, active, c_name AS name, c_mktsegment AS segment, c_acctbal AS acctbal,
    n_name AS nation, r_name AS region_name, loaddate FROM ships""", "ships")
def _(spark, sf_dir):
    flat = nested.flatten_once(nested.main_table(nested.unnest(fleet(spark, sf_dir), "data")))
    return flat.withColumn("region_name", F.col("region.region_name")).drop("region")


@query("explode_list_struct", """SELECT imo, e.engine_no,
    CASE WHEN e.engine_no IS NOT NULL THEN c_acctbal END AS power, loaddate
    FROM ships LEFT JOIN (VALUES (1), (2), (3)) AS e(engine_no) ON e.engine_no <= c_custkey % 4""", "ships")
def _(spark, sf_dir):
    return nested.child_table(nested.unnest(fleet(spark, sf_dir), "data"), "imo", "main_engines")


@query("explode_list_struct_nullable", """SELECT imo, e.engine_no,
    CASE WHEN e.engine_no IS NOT NULL THEN c_mktsegment END AS maker, loaddate
    FROM ships LEFT JOIN (VALUES (1), (2)) AS e(engine_no)
    ON e.engine_no <= c_custkey % 3 AND c_custkey % 5 <> 0""", "ships")
def _(spark, sf_dir):
    return nested.child_table(nested.unnest(fleet(spark, sf_dir), "data"), "imo", "aux_engines")


@query("explode_list_scalar", "SELECT imo, unnest(string_split(c_name, '#')) AS tags, loaddate FROM ships", "ships")
def _(spark, sf_dir):
    return nested.child_table(nested.unnest(fleet(spark, sf_dir), "data"), "imo", "tags")


@query("catalog_from_map", f"SELECT imo, signal, {', '.join(SIGNALS)}, loaddate FROM signals", "signals")
def _(spark, sf_dir):
    return nested.signals_to_rows(views.signal_payloads(spark, sf_dir))


PAYLOAD_LONG = "SELECT imo, signal, signal_timestamp, signal_value, loaddate FROM payload_cells"


@query("timeseries_long", PAYLOAD_LONG, "payload_cells")
def _(spark, sf_dir):
    return nested.timeseries_to_long(views.payloads(spark, sf_dir))


@query("timeseries_dense", """WITH s AS (SELECT DISTINCT imo, loaddate, signal FROM payload_cells),
    t AS (SELECT DISTINCT imo, loaddate, signal_timestamp FROM payload_cells)
    SELECT imo, signal, signal_timestamp, signal_value, loaddate
    FROM s JOIN t USING (imo, loaddate)
    LEFT JOIN payload_cells USING (imo, loaddate, signal, signal_timestamp)""", "payload_cells")
def _(spark, sf_dir):
    return nested.timeseries_to_long(views.payloads(spark, sf_dir), densify=True)


@query("landing_parse", PAYLOAD_LONG, "payload_cells")
def _(spark, sf_dir):
    path = work_path(spark, "landing")
    landing.write_landing(views.payloads(spark, sf_dir), path)
    return nested.timeseries_to_long(landing.read_bundles(spark, path, "Timeseries"))


@query("landing_files", PAYLOAD_LONG, "payload_cells")
def _(spark, sf_dir):
    path = work_path(spark, "landing-files")
    landing.write_files(views.payloads(spark, sf_dir), path)
    return nested.timeseries_to_long(landing.read_runs(spark, path, "Timeseries"))


def with_bad_cells(spark, sf_dir):
    """Every payload with a signal that has a key without a time and a value without a number."""
    bad = F.lit('{"bad":{"never":1,"2024-01-01T00:00:00Z":"n/a","2024-01-01T01:00:00Z":2},')
    rows = views.payloads(spark, sf_dir)
    return rows.withColumn("raw", F.concat(bad, F.substring("raw", F.lit(2), F.length("raw"))))


@query("timeseries_bad_cells", """SELECT imo, 'bad' AS signal, at_text AS "at", value, reason, loaddate FROM payload_keys,
    (VALUES ('never', '1', 'timestamp'), ('2024-01-01T00:00:00Z', 'n/a', 'value')) AS v(at_text, value, reason)""",
       "payload_keys")
def _(spark, sf_dir):
    return nested.bad_cells(with_bad_cells(spark, sf_dir))


@query("timeseries_strict", PAYLOAD_LONG + """ UNION ALL
    SELECT imo, 'bad', TIMESTAMP '2024-01-01 01:00:00', 2.0, loaddate FROM payload_keys""", "payload_keys")
def _(spark, sf_dir):
    return nested.timeseries_to_long(with_bad_cells(spark, sf_dir), strict=True)


@query("payload_quarantine", """SELECT imo, loaddate, status,
    CASE WHEN status = 'error' THEN 'not found' END AS detail FROM classified WHERE status <> 'ok'""", "classified")
def _(spark, sf_dir):
    return quality.split_errors(views.mixed_payloads(spark, sf_dir))[1].drop("entity", "raw")


@query("payload_accepted", """SELECT imo, signal, signal_timestamp, signal_value, loaddate
    FROM payload_cells JOIN classified USING (imo, loaddate) WHERE status = 'ok'""", "classified")
def _(spark, sf_dir):
    return nested.timeseries_to_long(quality.split_errors(views.mixed_payloads(spark, sf_dir))[0])


@query("run_audit", """SELECT loaddate, count(*) AS ships_total,
    count(*) FILTER (status = 'ok') AS ships_processed, count(*) FILTER (status <> 'ok') AS ships_failed,
    count(*) AS calls_total, count(*) FILTER (status IN ('ok', 'error')) AS calls_success,
    count(*) FILTER (status NOT IN ('ok', 'error')) AS calls_failed,
    count(*) FILTER (status <> 'ok') = 0 AS success
    FROM classified GROUP BY loaddate""", "classified")
def _(spark, sf_dir):
    return quality.run_audit(quality.classify_payloads(views.mixed_payloads(spark, sf_dir)))


@query("run_errors", """SELECT loaddate, imo, status,
    CASE status WHEN 'error' THEN 'not found' ELSE 'payload is ' || status END AS message
    FROM classified WHERE status <> 'ok'""", "classified")
def _(spark, sf_dir):
    return quality.run_errors(quality.classify_payloads(views.mixed_payloads(spark, sf_dir)))


# --- gaps --------------------------------------------------------------------------------------


def null_points(spark, sf_dir):
    return quality.gap_points(views.tele(spark, sf_dir))


@query("gap_intervals_1d", oracle.gaps(1), "nulls")
def _(spark, sf_dir):
    return gaps.gap_intervals(null_points(spark, sf_dir), timedelta(days=1))


@query("gap_intervals_3d", oracle.gaps(3), "nulls")
def _(spark, sf_dir):
    return gaps.gap_intervals(null_points(spark, sf_dir), timedelta(days=3))


@query("gap_sessions", oracle.gaps(5), "nulls")
def _(spark, sf_dir):
    return gaps.gap_sessions(null_points(spark, sf_dir), timedelta(days=5))


HOUR_GAPS = oracle.gaps(1, "null_hours").replace("INTERVAL 1 DAY", "INTERVAL 12 HOUR").replace(
    "WITH p AS", "WITH null_hours AS (SELECT * FROM tele_hour WHERE signal_value IS NULL), p AS")


@query("gap_intervals_12h", HOUR_GAPS, "tele_hour")
def _(spark, sf_dir):
    points = quality.gap_points(views.tele(spark, sf_dir, "hour"))
    return gaps.gap_intervals(points, timedelta(hours=12))


# Loads of even and of odd minutes are two runs: their gaps overlap, touch and lie in each other.
EVEN_MINUTE = "CAST(substr(loaddate, 16, 1) AS INTEGER) % 2 = 0"
# The first run that reports the end of a gap stamps it.
FIRST_STAMPS = f"""stamped AS (SELECT imo, signal, signal_timestamp, coalesce(least(even, odd), even, odd) AS loaddate FROM (
    SELECT imo, signal, signal_timestamp, max(loaddate) FILTER ({EVEN_MINUTE}) AS even,
           max(loaddate) FILTER (NOT ({EVEN_MINUTE})) AS odd FROM nulls GROUP BY ALL))"""


def two_runs(spark, sf_dir):
    points = null_points(spark, sf_dir)
    even = F.substring("loaddate", 16, 1).cast("int") % 2 == 0
    return points.filter(even), points.filter(~even)


@query("gaps_append", f"WITH {FIRST_STAMPS}, {oracle.gaps(1, 'stamped').strip()[5:]}", "nulls")
def _(spark, sf_dir):
    first, second = two_runs(spark, sf_dir)
    stored = materialize(gaps.gap_intervals(first, timedelta(days=1)))
    return gaps.append_gaps(stored, materialize(gaps.gap_intervals(second, timedelta(days=1))), timedelta(days=1))


# --- signals and pivots ------------------------------------------------------------------------


@query("distinct_signals", "SELECT DISTINCT signal FROM measured", "measured")
def _(spark, sf_dir):
    return pivot.distinct_signals(quality.measurements(views.tele(spark, sf_dir)))


@query("signal_counts", "SELECT signal, count(*) AS count FROM measured GROUP BY signal", "measured")
def _(spark, sf_dir):
    return pivot.signal_counts(quality.measurements(views.tele(spark, sf_dir)))


@query("top_signals", f"""SELECT {LONG} FROM measured WHERE signal IN (
    SELECT signal FROM measured GROUP BY signal ORDER BY count(*) DESC, signal LIMIT 3)""", "measured")
def _(spark, sf_dir):
    return pivot.keep_top_signals(quality.measurements(views.tele(spark, sf_dir)), 3)


BY_LOAD = f"""SELECT imo, signal_timestamp, loaddate, {oracle.pivot_columns(oracle.EVENT_TYPES)}
    FROM latest GROUP BY imo, signal_timestamp, loaddate"""
BY_KEY = f"""SELECT imo, signal_timestamp, max(loaddate) AS loaddate, {oracle.pivot_columns(oracle.EVENT_TYPES)}
    FROM latest GROUP BY imo, signal_timestamp"""


@query("pivot_by_load", BY_LOAD, "latest")
def _(spark, sf_dir):
    return pivot.pivot_long(latest(spark, sf_dir), pivot.signal_list(quality.measurements(views.tele(spark, sf_dir))),
                            unique=True)


@query("pivot_latest", BY_KEY, "latest")
def _(spark, sf_dir):
    return pivot.pivot_latest(latest(spark, sf_dir), pivot.signal_list(quality.measurements(views.tele(spark, sf_dir))))


@query("pivot_max", BY_LOAD.replace("FROM latest", "FROM measured"), "measured")
def _(spark, sf_dir):
    return pivot.pivot_long(quality.measurements(views.tele(spark, sf_dir)))


@query("pivot_conditional", BY_LOAD, "latest")
def _(spark, sf_dir):
    return pivot.pivot_conditional(latest(spark, sf_dir),
                                   pivot.signal_list(quality.measurements(views.tele(spark, sf_dir))))


@query("pivot_selected", f"""SELECT imo, signal_timestamp, loaddate, {oracle.pivot_columns(['error', 'purchase', 'signup'])}
    FROM latest WHERE signal IN ('error', 'purchase', 'signup') GROUP BY imo, signal_timestamp, loaddate""", "latest")
def _(spark, sf_dir):
    return pivot.pivot_long(latest(spark, sf_dir), ["signup", "error", "purchase"], unique=True)


@query("pivot_stats", f"""WITH w AS ({BY_LOAD}) SELECT count(*) AS n_rows, CAST(8 AS BIGINT) AS n_columns,
    count(DISTINCT imo) AS n_ships, min(signal_timestamp) AS first_timestamp, max(signal_timestamp) AS last_timestamp
    FROM w""", "latest")
def _(spark, sf_dir):
    signals = pivot.signal_list(quality.measurements(views.tele(spark, sf_dir)))
    return pivot.pivot_stats(pivot.pivot_long(latest(spark, sf_dir), signals, unique=True))


def wide_latest(spark, sf_dir):
    rows = quality.measurements(views.wide_tele(spark, sf_dir))
    return dedup.latest_wins(rows, order=[*views.TIE_BREAK, "signal_value"])


@query("wide_latest_wins", f"SELECT {LONG} FROM wide_latest", "wide_latest")
def _(spark, sf_dir):
    return wide_latest(spark, sf_dir)


@query("wide_pivot_latest", f"""SELECT imo, signal_timestamp, max(loaddate) AS loaddate,
    {oracle.pivot_columns(oracle.WIDE_SIGNALS)} FROM wide_latest GROUP BY imo, signal_timestamp""", "wide_latest")
def _(spark, sf_dir):
    signals = pivot.signal_list(quality.measurements(views.wide_tele(spark, sf_dir)))
    return pivot.pivot_latest(wide_latest(spark, sf_dir), signals)


@query("export_roundtrip", BY_LOAD, "latest")
def _(spark, sf_dir):
    path = work_path(spark, "export")
    signals = pivot.signal_list(quality.measurements(views.tele(spark, sf_dir)))
    tables.export_pivot(pivot.pivot_long(latest(spark, sf_dir), signals, unique=True), path)
    return spark.read.parquet(path)


# --- tables ------------------------------------------------------------------------------------


@query("void_to_string", "SELECT imo, signal, friendly_name, CAST(NULL AS VARCHAR) AS unit FROM catalog", "catalog")
def _(spark, sf_dir):
    return nested.void_to_string(views.catalog(spark, sf_dir).withColumn("unit", F.lit(None)))


@query("table_maintenance", f"""SELECT {LONG.replace('signal_value', 'CASE WHEN signal_timestamp >= TIMESTAMP '
    f"'{HISTORY_DAY}' THEN signal_value * 2 ELSE signal_value END AS signal_value")}
    FROM measured UNION ALL SELECT {LONG} FROM nulls""", "measured", "nulls")
def _(spark, sf_dir):
    """Write, overwrite some partitions from the table itself, append, read with a schema."""
    path = work_path(spark, "table")
    rows = views.tele(spark, sf_dir).withColumn("signal_date", F.to_date("signal_timestamp"))
    tables.write_table(quality.measurements(rows), path, partition_by=["signal_date"])
    late = tables.read_table(spark, path, rows.schema).filter(F.col("signal_date") >= F.lit(HISTORY_DAY).cast("date"))
    tables.overwrite_partitions(late.withColumn("signal_value", F.col("signal_value") * 2), path, ["signal_date"])
    tables.append_table(rows.filter(F.col("signal_value").isNull()), path, ["signal_date"])
    return tables.read_table(spark, path, rows.schema).drop("signal_date")


# --- upserts and schema evolution --------------------------------------------------------------

ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
STORED_ORDERS = f"SELECT {', '.join(ORDER_COLUMNS)} FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01'"
LOADED_ORDERS = """SELECT o_orderkey, o_custkey, 'U' AS o_orderstatus, o_totalprice * 2 AS o_totalprice, o_orderdate,
    o_orderpriority FROM orders WHERE o_orderdate >= TIMESTAMP '1999-01-01'"""


@query("merge_upsert_1key", oracle.merge(STORED_ORDERS, LOADED_ORDERS, ["o_orderkey"], ORDER_COLUMNS))
def _(spark, sf_dir):
    orders = views.table(spark, sf_dir, "orders")
    stored = orders.filter(F.col("o_orderdate") < F.lit("2000-01-01"))
    loaded = orders.filter(F.col("o_orderdate") >= F.lit("1999-01-01")).withColumns(
        {"o_orderstatus": F.lit("U"), "o_totalprice": F.col("o_totalprice") * 2})
    return upsert.merge_upsert(stored, loaded, ["o_orderkey"])


PARTIAL = ["o_orderkey", "o_orderstatus"]


@query("merge_upsert_partial", """SELECT o_orderkey,
    CASE WHEN o_orderdate >= TIMESTAMP '1999-01-01' THEN 'U' ELSE o_orderstatus END AS o_orderstatus,
    CASE WHEN o_orderdate < TIMESTAMP '2000-01-01' THEN o_totalprice END AS o_totalprice FROM orders""")
def _(spark, sf_dir):
    orders = views.table(spark, sf_dir, "orders")
    stored = orders.filter(F.col("o_orderdate") < F.lit("2000-01-01")).select(*PARTIAL, "o_totalprice")
    loaded = orders.filter(F.col("o_orderdate") >= F.lit("1999-01-01")).withColumn("o_orderstatus", F.lit("U"))
    return upsert.merge_upsert(stored, loaded.select(*PARTIAL), ["o_orderkey"])


MAPPING_STORED = "SELECT imo, signal, upper(signal) AS label FROM catalog WHERE signal < 'r'"
MAPPING_LOADED = "SELECT imo, signal, friendly_name AS label FROM catalog WHERE signal > 'd'"


@query("merge_upsert_2key", oracle.merge(MAPPING_STORED, MAPPING_LOADED, ["imo", "signal"],
                                         ["imo", "signal", "label"]), "catalog")
def _(spark, sf_dir):
    mapping = views.stored_catalog(spark, sf_dir)
    stored = mapping.filter(F.col("signal") < "r").select("imo", "signal", F.upper("signal").alias("label"))
    loaded = mapping.filter(F.col("signal") > "d").select("imo", "signal", F.col("friendly_name").alias("label"))
    return upsert.merge_upsert(stored, loaded, ["imo", "signal"])


LINE_KEYS = ["l_orderkey", "l_partkey", "l_suppkey"]
LINE_COLUMNS = [*LINE_KEYS, "l_quantity", "l_extendedprice", "l_shipdate"]
UNIQUE_LINES = f"""SELECT {', '.join(LINE_KEYS)}, max(l_quantity) AS l_quantity, max(l_extendedprice) AS l_extendedprice,
    max(l_shipdate) AS l_shipdate FROM lineitem GROUP BY {', '.join(LINE_KEYS)}"""


@query("merge_upsert_3key", "WITH lines AS (" + UNIQUE_LINES + ")" + oracle.merge(
    "SELECT * FROM lines WHERE l_shipdate < TIMESTAMP '2000-01-01'",
    "SELECT * REPLACE (l_quantity + 100 AS l_quantity) FROM lines WHERE l_shipdate >= TIMESTAMP '1998-01-01'",
    LINE_KEYS, LINE_COLUMNS))
def _(spark, sf_dir):
    lines = materialize(views.table(spark, sf_dir, "lineitem").groupBy(*LINE_KEYS).agg(
        *[F.max(c).alias(c) for c in ("l_quantity", "l_extendedprice", "l_shipdate")]))
    stored = lines.filter(F.col("l_shipdate") < F.lit("2000-01-01"))
    loaded = lines.filter(F.col("l_shipdate") >= F.lit("1998-01-01")).withColumn(
        "l_quantity", F.col("l_quantity") + 100)
    return upsert.merge_upsert(stored, loaded, LINE_KEYS)


OLD_SIGNALS, NEW_SIGNALS = ["click", "error", "purchase"], ["error", "purchase", "signup", "view"]


def wide_tables(spark, sf_dir):
    """A stored wide table and a later, overlapping load with other signals."""
    rows = materialize(latest(spark, sf_dir))
    stored = pivot.pivot_latest(rows.filter(F.col("signal_timestamp") < F.lit(HISTORY_DAY).cast("timestamp")),
                                OLD_SIGNALS)
    loaded = pivot.pivot_latest(rows.filter(F.col("signal_timestamp") >= F.lit(CURRENT_DAY).cast("timestamp")),
                                NEW_SIGNALS)
    return materialize(stored), loaded


def _wide_sql(signals: list[str], condition: str) -> str:
    names = ", ".join(f"'{s}'" for s in signals)
    return f"""SELECT imo, signal_timestamp, max(loaddate) AS loaddate, {oracle.pivot_columns(signals)}
        FROM latest WHERE {condition} AND signal IN ({names}) GROUP BY imo, signal_timestamp"""


WIDE_TABLES = f"""WITH t AS ({_wide_sql(OLD_SIGNALS, f"signal_timestamp < TIMESTAMP '{HISTORY_DAY}'")}),
    s AS ({_wide_sql(NEW_SIGNALS, f"signal_timestamp >= TIMESTAMP '{CURRENT_DAY}'")})"""
UPSERT_SQL = WIDE_TABLES + """
    SELECT coalesce(s.imo, t.imo) AS imo, coalesce(s.signal_timestamp, t.signal_timestamp) AS signal_timestamp,
           CASE WHEN s.imo IS NOT NULL THEN s.loaddate ELSE t.loaddate END AS loaddate, t.click AS click,
           {error} AS error, {purchase} AS purchase, s.signup AS signup, s.view AS view
    FROM t FULL OUTER JOIN s ON t.imo = s.imo AND t.signal_timestamp = s.signal_timestamp"""


@query("schema_evolve", WIDE_TABLES + """ SELECT imo, signal_timestamp, loaddate, click, error, purchase,
    CAST(NULL AS DOUBLE) AS signup, CAST(NULL AS DOUBLE) AS view FROM t""", "latest")
def _(spark, sf_dir):
    return upsert.evolve(*wide_tables(spark, sf_dir))


@query("pivot_upsert", UPSERT_SQL.format(**{c: f"CASE WHEN s.imo IS NOT NULL THEN s.{c} ELSE t.{c} END"
                                            for c in ("error", "purchase")}), "latest")
def _(spark, sf_dir):
    return upsert.pivot_upsert(*wide_tables(spark, sf_dir))


@query("pivot_upsert_keep", UPSERT_SQL.format(**{c: f"coalesce(s.{c}, t.{c})" for c in ("error", "purchase")})
       .replace("CASE WHEN s.imo IS NOT NULL THEN s.loaddate ELSE t.loaddate END", "coalesce(s.loaddate, t.loaddate)"),
       "latest")
def _(spark, sf_dir):
    return upsert.pivot_upsert(*wide_tables(spark, sf_dir), ignore_null=True)


# --- daily summary -----------------------------------------------------------------------------

TAGGED = "imo, signal, friendly_name, signal_timestamp, signal_value, loaddate, event_id, ts, tag"
BY_EVENT = ["ts", "event_id"]


@query("daily_summary", f"SELECT {TAGGED} FROM winners WHERE tag <> 'hist'", "winners")
def _(spark, sf_dir):
    return summary.daily_summary(views.tagged(spark, sf_dir), order=BY_EVENT)


@query("daily_summary_by_signal", f"""WITH first_rows AS (SELECT * FROM tagged QUALIFY row_number() OVER (
    PARTITION BY imo, signal_timestamp, signal ORDER BY tag_rank, ts, event_id) = 1)
    SELECT {TAGGED} FROM first_rows WHERE tag <> 'hist'""", "tagged")
def _(spark, sf_dir):
    return summary.daily_summary(summary.tag_sources(*views.sources(spark, sf_dir)), key=summary.SAFE_KEY, order=BY_EVENT)


@query("daily_delta", f"SELECT {TAGGED} FROM winners WHERE tag = 'new'", "winners")
def _(spark, sf_dir):
    return summary.daily_delta(views.tagged(spark, sf_dir), order=BY_EVENT)


@query("ref_rollover", f"""SELECT {TAGGED.replace(', tag', '')}, 'hist' AS tag FROM tagged
    WHERE (tag = 'hist' AND substr(loaddate, 1, 10) > '2024/01/25') OR tag = 'today'""", "tagged")
def _(spark, sf_dir):
    hist, today, _ = views.sources(spark, sf_dir)
    return summary.rollover(hist, today, quality.cutoff_day(AS_OF, runs.HISTORY_DAYS))


@query("summary_by_pattern", f"""SELECT {LONG}, strftime(signal_timestamp, '%Y%m%d') AS summary_date FROM measured
    WHERE strftime(signal_timestamp, '%Y%m%d') LIKE '2024011%'""", "measured")
def _(spark, sf_dir):
    dated = quality.measurements(views.tele(spark, sf_dir)).withColumn(
        "summary_date", F.date_format("signal_timestamp", "yyyyMMdd"))
    return tables.matching_summaries(dated, "2024011*")


# --- runs and retention ------------------------------------------------------------------------

RUNS = LONG + ", run_date, run_ts"


@query("latest_run_per_day", f"""WITH last AS (SELECT run_date, max(run_ts) AS run_ts FROM tele_runs
    GROUP BY run_date ORDER BY run_date DESC LIMIT 10) SELECT {RUNS} FROM tele_runs JOIN last USING (run_date, run_ts)""",
       "tele_runs")
def _(spark, sf_dir):
    return runs.latest_run_per_day(views.tele_runs(spark, sf_dir), max_days=10)


@query("history_last_run_per_ship", f"""WITH recent AS (SELECT * FROM minute_runs
        WHERE run_date > DATE '2024-01-25' AND run_date <= DATE '2024-01-30'),
    hours AS (SELECT run_date, max(date_trunc('hour', run_ts)) AS run_hour FROM recent GROUP BY run_date),
    last_hour AS (SELECT r.* FROM recent r JOIN hours h
        ON r.run_date = h.run_date AND date_trunc('hour', r.run_ts) = h.run_hour)
    SELECT {RUNS} FROM last_hour QUALIFY run_ts = max(run_ts) OVER (PARTITION BY imo, run_date)""".replace(
    "WITH recent", "WITH minute_runs AS (SELECT * REPLACE (strptime(loaddate, '%Y/%m/%d/%H/%M') AS run_ts) "
                   "FROM tele_runs), recent"), "tele_runs")
def _(spark, sf_dir):
    from fleetframe.functions import run_time

    minute_runs = views.tele_runs(spark, sf_dir).withColumn("run_ts", run_time("loaddate"))
    return runs.history_window(minute_runs, AS_OF)


@query("run_sketches", """SELECT count(*) AS n_rows, count(signal_value) AS n_values, min(signal_timestamp) AS first,
    max(signal_timestamp) AS last, count(DISTINCT imo) AS ships, count(DISTINCT (imo, signal)) AS series,
    count(DISTINCT (imo, signal, signal_timestamp)) AS points, true AS counts_hold, true AS median_holds FROM tele_runs""", "tele_runs")
def _(spark, sf_dir):
    """Sketches of every hourly run, merged by day, then over all days; held against the exact figures."""
    rows = views.tele_runs(spark, sf_dir)
    of_runs = statistics.run_sketches(rows, ["run_date", "run_ts"])
    whole = statistics.estimates(statistics.merge_sketches(statistics.merge_sketches(of_runs, ["run_date"])), (0.5,))
    found = whole.withColumns({"first": F.unix_micros("first"), "last": F.unix_micros("last")}).first()
    names, median = list(statistics.DISTINCT), found.quantiles[0]
    exact = rows.agg(
        *[F.count_distinct(F.struct(*statistics.DISTINCT[n])).alias(n) for n in names],
        F.count_if(F.col("signal_value") < median).alias("below"), F.count_if(F.col("signal_value") <= median).alias("upto"))
    counts = [F.abs(F.lit(found[n]) - F.col(n)) <= 3 * statistics.COUNT_ERROR * F.col(n) for n in names]
    half, slack = found.n_values / 2, 2 * statistics.RANK_ERROR * found.n_values
    return exact.select(
        F.lit(found.n_rows).cast("long").alias("n_rows"), F.lit(found.n_values).cast("long").alias("n_values"),
        F.timestamp_micros(F.lit(found["first"])).alias("first"), F.timestamp_micros(F.lit(found["last"])).alias("last"), *names,
        (counts[0] & counts[1] & counts[2]).alias("counts_hold"),
        ((F.col("below") <= half + slack) & (F.col("upto") >= half - slack)).alias("median_holds"))


@query("retention_expired", """SELECT CAST(o_orderdate AS DATE) AS run_date, count(*) AS row_count FROM orders
    WHERE o_orderdate < TIMESTAMP '2001-08-01' - INTERVAL 90 DAY GROUP BY ALL""")
def _(spark, sf_dir):
    orders = views.table(spark, sf_dir, "orders").withColumn("run_date", F.to_date("o_orderdate"))
    return runs.expired(orders, date(2001, 8, 1))


@query("retention_kept", f"""SELECT {', '.join(ORDER_COLUMNS)} FROM orders
    WHERE o_orderdate >= TIMESTAMP '2001-08-01' - INTERVAL 90 DAY""")
def _(spark, sf_dir):
    orders = views.table(spark, sf_dir, "orders").withColumn("run_date", F.to_date("o_orderdate"))
    return runs.kept(orders, date(2001, 8, 1)).drop("run_date")


@query("landing_inventory", """SELECT imo, count(*) AS files, count(DISTINCT run_date) AS days,
    count(DISTINCT date_trunc('month', run_date)) AS months, count(DISTINCT date_trunc('year', run_date)) AS years
    FROM (SELECT DISTINCT imo, run_date, run_ts FROM tele_runs WHERE run_date > DATE '2024-01-30' - 20) GROUP BY imo""",
       "tele_runs")
def _(spark, sf_dir):
    files = views.tele_runs(spark, sf_dir).select("imo", loaddate_of("run_ts").alias("loaddate")).distinct()
    return landing.ship_files(files, max_days=20)


# --- streams (run to completion, then read back as a table) --------------------------------------


@query("stream_landing", PAYLOAD_LONG, "payload_cells")
def _(spark, sf_dir):
    return replay.landing(spark, views.payloads(spark, sf_dir))


@query("stream_landing_runs", PAYLOAD_LONG, "payload_cells")
def _(spark, sf_dir):
    return replay.landing_runs(spark, views.payloads(spark, sf_dir))


@query("stream_latest_wins", f"SELECT {LONG} FROM latest", "latest")
def _(spark, sf_dir):
    return replay.latest_wins(quality.measurements(views.tele(spark, sf_dir)), order=views.TIE_BREAK)


@query("stream_gap_sessions", oracle.gaps(1), "nulls")
def _(spark, sf_dir):
    return replay.gap_sessions(null_points(spark, sf_dir), timedelta(days=1))


@query("stream_late_gaps", oracle.gaps(1), "nulls")
def _(spark, sf_dir):
    return replay.late_gaps(null_points(spark, sf_dir), timedelta(days=1), timedelta(days=5))


@query("stream_gap_state", oracle.gaps(1), "nulls")
def _(spark, sf_dir):
    return replay.gap_state(null_points(spark, sf_dir), timedelta(days=1))


@query("stream_first_seen", f"""SELECT {LONG} FROM measured QUALIFY row_number() OVER (
    PARTITION BY imo, signal, signal_timestamp ORDER BY loaddate, event_id) = 1""", "measured")
def _(spark, sf_dir):
    rows = quality.measurements(views.tele(spark, sf_dir))
    return replay.first_seen(rows, dedup.POINT_KEY, views.TIE_BREAK)


# --- jobs (two overlapping runs over all payloads, then a table read back) ------------------------

RUN_1, RUN_2 = "2024/01/30/00/00", "2024/01/30/06/00"
# Payloads before the first day are in run 1 alone, those from the second day on in run 2 alone.
OVERLAP_DAYS = "2024/01/10", "2024/01/20"
JOB_CELLS = f"""job_cells AS (SELECT c.imo, c.signal, c.signal_timestamp, c.signal_value, c.loaddate AS payload,
        CASE WHEN c.loaddate >= '{OVERLAP_DAYS[0]}' THEN '{RUN_2}' ELSE '{RUN_1}' END AS loaddate
    FROM payload_cells c WHERE c.imo IN (SELECT imo FROM ships WHERE is_active)),
    job_rows AS (SELECT * EXCLUDE (payload) FROM job_cells WHERE signal_value IS NOT NULL)"""


def landed(spark, sf_dir) -> jobs.Lake:
    """A lake whose landing zone holds both runs."""
    folder = work_path(spark, "job")
    lake = jobs.Lake(f"{folder}/landing", f"{folder}/tables", gap_threshold=timedelta(hours=3), bundled=True)
    series = materialize(views.payloads(spark, sf_dir))
    first, second = series.filter(F.col("loaddate") < OVERLAP_DAYS[1]), series.filter(F.col("loaddate") >= OVERLAP_DAYS[0])
    for run, frames in ((RUN_1, [views.fleet_payloads(spark, sf_dir), views.signal_payloads(spark, sf_dir), first]),
                        (RUN_2, [second])):
        for frame in frames:
            landing.write_landing(nested.stamp(frame, run), lake.landing)
    return lake


def ingested(spark, sf_dir) -> jobs.Lake:
    lake = landed(spark, sf_dir)
    jobs.run_jobs(spark, lake, RUN_1)
    jobs.run_jobs(spark, lake, RUN_2, mode="timeseries")
    return lake


@query("job_fleet", f"""SELECT imo, active, c_name AS name, c_mktsegment AS segment, c_acctbal AS acctbal, n_name AS home_nation,
    is_active, '{RUN_1}' AS loaddate FROM ships""", "ships")
def _(spark, sf_dir):
    lake = landed(spark, sf_dir)
    jobs.ingest_fleet(spark, lake, jobs.Run(RUN_1))
    active = tables.read_table(spark, lake.path("active_ships")).withColumn("is_active", F.lit(True))
    ships = tables.read_table(spark, lake.path("ships")).withColumn("home_nation", F.col("home.nation"))
    kept = ships.select("imo", "active", "name", "segment", "acctbal", "home_nation", "loaddate")
    return kept.join(active, "imo", "left").fillna(False, "is_active")


def odd_fleet(spark, sf_dir):
    """Every seventh ship has its balance as text, every ninth its home port as a plain name."""
    raw = F.col("raw")
    key = F.get_json_object("raw", "$[0].imo").cast("long")
    balance = F.when(key % 7 == 0, F.regexp_replace(raw, r'"acctbal":([-0-9.E]+)', r'"acctbal":"$1 EUR"')).otherwise(raw)
    home = F.when(key % 9 == 0, F.regexp_replace(balance, r'"home":\{"nation":"([^"]*)".*?\}\}', r'"home":"$1"')).otherwise(balance)
    return views.fleet_payloads(spark, sf_dir).withColumn("raw", home)


@query("job_fleet_variant", f"""SELECT imo, active, c_name AS name, c_mktsegment AS segment,
        CASE WHEN CAST(imo AS BIGINT) % 7 <> 0 THEN c_acctbal END AS acctbal,
        CASE WHEN CAST(imo AS BIGINT) % 9 <> 0 THEN n_name END AS home_nation,
        CAST((CAST(imo AS BIGINT) % 7 = 0) AS INTEGER) + CAST((CAST(imo AS BIGINT) % 9 = 0) AS INTEGER) AS odd, '{RUN_1}' AS loaddate
    FROM ships""", "ships")
def _(spark, sf_dir):
    folder = work_path(spark, "job-variant")
    lake = jobs.Lake(f"{folder}/landing", f"{folder}/tables", bundled=True, typed_by_majority=True)
    for frame in (odd_fleet(spark, sf_dir), views.signal_payloads(spark, sf_dir)):
        landing.write_landing(nested.stamp(frame, RUN_1), lake.landing)
    jobs.ingest_fleet(spark, lake, jobs.Run(RUN_1))
    ships = tables.read_table(spark, lake.path("ships")).withColumn("home_nation", F.col("home.nation"))
    odd = tables.read_table(spark, lake.path("odd_values")).groupBy("imo").agg(F.count(F.lit(1)).cast("int").alias("odd"))
    kept = ships.select("imo", "active", "name", "segment", "acctbal", "home_nation", "loaddate")
    return kept.join(odd.withColumn("imo", F.col("imo").cast("string")), "imo", "left").fillna(0, "odd")


@query("job_children", f"""SELECT 'main_engines' AS list, imo, e.engine_no, CASE WHEN e.engine_no IS NOT NULL THEN c_acctbal END AS power,
        '{RUN_1}' AS loaddate
    FROM ships LEFT JOIN (VALUES (1), (2), (3)) AS e(engine_no) ON e.engine_no <= c_custkey % 4
    UNION ALL SELECT 'tags', imo, NULL, NULL, '{RUN_1}' FROM (SELECT imo, unnest(string_split(c_name, '#')) FROM ships)""", "ships")
def _(spark, sf_dir):
    """The child tables that the fleet job stores, of lists of structs and of lists of scalars."""
    lake = landed(spark, sf_dir)
    jobs.ingest_fleet(spark, lake, jobs.Run(RUN_1))
    engines = tables.read_table(spark, lake.path("ships_main_engines")).select(
        F.lit("main_engines").alias("list"), "imo", F.col("engine_no").cast("int"), "power", "loaddate")
    tags = tables.read_table(spark, lake.path("ships_tags")).select(
        F.lit("tags").alias("list"), "imo", F.lit(None).cast("int").alias("engine_no"), F.lit(None).cast("double").alias("power"), "loaddate")
    return engines.unionByName(tags)


@query("job_signals", "SELECT signal, " + ", ".join(SIGNALS) + """ FROM signals WHERE imo IN (SELECT imo FROM ships WHERE is_active)
    QUALIFY row_number() OVER (PARTITION BY signal ORDER BY imo) = 1""", "signals", "ships")
def _(spark, sf_dir):
    lake = landed(spark, sf_dir)
    jobs.ingest_fleet(spark, lake, jobs.Run(RUN_1))
    return jobs.definitions(spark, lake)


@query("job_timeseries", f"WITH {JOB_CELLS} SELECT * FROM job_rows", "payload_cells", "ships")
def _(spark, sf_dir):
    lake = ingested(spark, sf_dir)
    run = jobs.stored_runs(spark, lake).filter(F.col("run") == jobs.Run(RUN_2).id)
    return run.drop("run_date", "run", "run_ts")


@query("job_gaps", f"""WITH {JOB_CELLS}, job_nulls AS (
        SELECT s.imo, s.signal, t.signal_timestamp, s.payload FROM (SELECT DISTINCT imo, payload, signal FROM job_cells) s
        JOIN (SELECT DISTINCT imo, payload, signal_timestamp FROM job_cells) t USING (imo, payload)
        LEFT JOIN job_cells c ON c.imo = s.imo AND c.payload = s.payload AND c.signal = s.signal
            AND c.signal_timestamp = t.signal_timestamp WHERE c.signal_value IS NULL),
    stamped AS (SELECT imo, signal, signal_timestamp,
        min(CASE WHEN payload < '{OVERLAP_DAYS[1]}' THEN '{RUN_1}' ELSE '{RUN_2}' END) AS loaddate FROM job_nulls GROUP BY ALL),
    {oracle.gaps(1, "stamped").replace("INTERVAL 1 DAY", "INTERVAL 3 HOUR").strip()[5:]}""", "payload_cells", "ships")
def _(spark, sf_dir):
    return tables.read_table(spark, ingested(spark, sf_dir).path("gaps")).drop("gap_date")


@query("job_daily", f"""WITH {JOB_CELLS}, landed AS (
        SELECT imo, signal, signal_timestamp, signal_value, payload, run.loaddate FROM job_cells, (VALUES
            ('{RUN_1}'), ('{RUN_2}')) AS run(loaddate)
        WHERE signal_value IS NOT NULL AND CASE run.loaddate WHEN '{RUN_1}' THEN payload < '{OVERLAP_DAYS[1]}'
            ELSE payload >= '{OVERLAP_DAYS[0]}' END)
    SELECT l.imo, l.signal, friendly_name, signal_timestamp, signal_value, loaddate FROM landed l
    LEFT JOIN catalog c ON c.imo = l.imo AND c.signal = l.signal QUALIFY row_number() OVER (
        PARTITION BY signal_timestamp, l.imo, friendly_name ORDER BY loaddate, l.signal, signal_value) = 1""",
       "payload_cells", "ships", "catalog")
def _(spark, sf_dir):
    lake = landed(spark, sf_dir)
    jobs.run_jobs(spark, lake, RUN_1, daily=True)
    jobs.run_jobs(spark, lake, RUN_2, mode="timeseries", daily=True)
    return jobs.summary_of(spark, lake, jobs.Run(RUN_2).day)


@query("job_export", f"""WITH {JOB_CELLS} SELECT imo, signal_timestamp, loaddate, {oracle.pivot_columns(oracle.EVENT_TYPES)}
    FROM job_rows GROUP BY imo, signal_timestamp, loaddate""", "payload_cells", "ships")
def _(spark, sf_dir):
    lake = ingested(spark, sf_dir)
    jobs.export_pivot(spark, lake, lake.path("export"), max_days=1)
    return tables.read_table(spark, lake.path("export"))


@query("job_gold", f"""WITH {JOB_CELLS} SELECT imo, signal_timestamp, max(loaddate) AS loaddate,
    {oracle.pivot_columns(oracle.EVENT_TYPES)} FROM job_rows GROUP BY imo, signal_timestamp""", "payload_cells", "ships")
def _(spark, sf_dir):
    lake = ingested(spark, sf_dir)
    for run in (RUN_1, RUN_2):
        jobs.load_gold(spark, lake, jobs.Run(run))
    return jobs.gold(spark, lake).drop("signal_date")
