"""Telemetry views over the star-schema tables: every row of `events`, `customer`, `lineitem` is used.

Ships are customers/users (imo = 9000000 + key), signals are event types. The same views exist as SQL
in `fleetframe.oracle`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetframe.functions import LOADDATE_FORMAT, load_day, run_time
from fleetframe.operators.dedup import latest_wins
from fleetframe.session import materialize

TIE_BREAK = ["loaddate", "event_id"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _imo(column: str):
    return (F.lit(9000000) + F.col(column)).cast("string")


def _ts(column: str):
    return F.col(column).cast("timestamp")


def tele(spark: SparkSession, sf_dir: str, grain: str = "day") -> DataFrame:
    """Long telemetry. The coarse time grid makes genuine repeated loads of a point."""
    return table(spark, sf_dir, "events").select(
        _imo("user_id").alias("imo"),
        F.col("event_type").alias("signal"),
        F.date_trunc(grain, _ts("ts")).alias("signal_timestamp"),
        # Written so that "not null" reaches the scan as a comparison.
        F.when(F.col("value") >= 10, F.col("value")).alias("signal_value"),
        F.date_format(_ts("ts"), LOADDATE_FORMAT).alias("loaddate"),
        "event_id",
    )


def tele_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Telemetry with hourly runs: `run_date`, `run_ts`."""
    return tele(spark, sf_dir).withColumns({
        "run_date": F.to_date(run_time("loaddate")),
        "run_ts": F.date_trunc("hour", run_time("loaddate")),
    })


def friendly_name():
    return (
        F.when(F.col("event_type") == "error", F.lit(None))
        .when(F.col("user_id") % 7 == 0, F.concat(F.upper("event_type"), F.lit(" (alt)")))
        .otherwise(F.upper("event_type"))
    )


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signal mapping (imo, signal, friendly_name); some names are null, some signals have two."""
    events = table(spark, sf_dir, "events")
    return events.select(_imo("user_id").alias("imo"), F.col("event_type").alias("signal"),
                         friendly_name().alias("friendly_name")).distinct()


def stored_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mapping as a table of its own, as it is in operation: read several times, derived once."""
    return materialize(catalog(spark, sf_dir))


def tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measurements with name, exact event time and the source each row is assigned to."""
    rows = table(spark, sf_dir, "events").select(
        _imo("user_id").alias("imo"),
        F.col("event_type").alias("signal"),
        friendly_name().alias("friendly_name"),
        F.date_trunc("day", _ts("ts")).alias("signal_timestamp"),
        F.col("value").alias("signal_value"),
        F.date_format(_ts("ts"), LOADDATE_FORMAT).alias("loaddate"),
        "event_id",
        _ts("ts").alias("ts"),
        F.element_at(F.array(F.lit("hist"), F.lit("today"), F.lit("new")),
                     (F.col("event_id") % 3 + 1).cast("int")).alias("tag"),
    )
    return rows.filter(F.col("signal_value") >= 10)


def sources(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """The three sources hist, today and new."""
    rows = tagged(spark, sf_dir)
    return [rows.filter(F.col("tag") == tag).drop("tag") for tag in ("hist", "today", "new")]


def latest_cells(spark: SparkSession, sf_dir: str, grain: str = "hour") -> DataFrame:
    return latest_wins(tele(spark, sf_dir, grain), order=TIE_BREAK)


def payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Time-series payloads (entity, imo, loaddate, raw), one per ship and day, hourly points.

    After deduplication a payload has at most 24 points per signal, so the groups are small. Both
    levels are collected where the payload's rows are placed.
    """
    cells = latest_cells(spark, sf_dir).withColumn("load_day", load_day("loaddate")).repartition("imo", "load_day")
    at = F.date_format("signal_timestamp", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    per_signal = cells.groupBy("imo", "load_day", "signal").agg(
        F.map_from_entries(F.collect_list(F.struct(at, F.col("signal_value")))).alias("points")
    )
    per_ship = per_signal.groupBy("imo", "load_day").agg(
        F.map_from_entries(F.collect_list(F.struct("signal", "points"))).alias("signals")
    )
    body = F.to_json("signals", {"ignoreNullFields": "false"})
    raw = F.concat(F.lit('{"timestamp":"'), F.translate("load_day", "/", "-"), F.lit('T00:00:00Z",'),
                   F.substring(body, F.lit(2), F.length(body)))
    return per_ship.select(
        F.lit("Timeseries").alias("entity"), "imo",
        F.concat("load_day", F.lit("/00/00")).alias("loaddate"), raw.alias("raw"),
    )


def mixed_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads with bad answers among them, by the last digit of the day of month."""
    digit = F.substring("loaddate", 10, 1)
    raw = (
        F.when(digit == "1", '{"detail":"not found"}')
        .when(digit == "2", "[]")
        .when(digit == "3", F.concat(F.lit('{"broken":'), F.col("raw")))
        .otherwise(F.col("raw"))
    )
    return payloads(spark, sf_dir).withColumn("raw", raw)


def signal_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signal catalogue payloads, one per ship: {imo, signals: {signal: definition}}."""
    definition = F.struct(
        "friendly_name",
        F.lit(None).cast("string").alias("unit"),
        F.upper(F.substring("signal", 1, 3)).alias("object_code"),
        F.concat(F.lit("N-"), "signal").alias("name_code"),
        F.lit("events").alias("group_name"),
        F.concat("signal", F.lit("-"), F.substring("imo", 7, 1)).alias("sub_group"),
    )
    per_ship = catalog(spark, sf_dir).groupBy("imo").agg(
        F.map_from_entries(F.collect_list(F.struct("signal", definition))).alias("signals")
    )
    raw = F.to_json(F.struct("imo", "signals"), {"ignoreNullFields": "false"})
    return per_ship.select(F.lit("Signals").alias("entity"), "imo",
                           F.lit("2024/01/31/00/00").alias("loaddate"), raw.alias("raw"))


FLEET_DATA = (
    "name string, segment string, acctbal double, home struct<nation: string, region: struct<region_name: string>>, "
    "main_engines array<struct<engine_no: int, power: double>>, "
    "aux_engines array<struct<engine_no: int, maker: string>>, tags array<string>"
)
FLEET_SHIP = f"imo string, active boolean, data struct<{FLEET_DATA}>"


def fleet_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fleet payloads, one ship per payload, with empty and null lists and all states of `active`."""
    nations = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    # A row is small and its payload is not: the file of many ships is one split, its rows are dealt to all tasks.
    customers = table(spark, sf_dir, "customer").repartition("c_custkey")
    ships = customers.join(nations, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    engines = F.expr("transform(slice(array(1, 2, 3), 1, cast(c_custkey % 4 as int)), "
                     "i -> named_struct('engine_no', i, 'power', c_acctbal))")
    aux = F.expr("if(c_custkey % 5 = 0, null, transform(slice(array(1, 2), 1, cast(c_custkey % 3 as int)), "
                 "i -> named_struct('engine_no', i, 'maker', c_mktsegment)))")
    data = F.struct(
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("segment"),
        F.col("c_acctbal").alias("acctbal"),
        F.struct(F.col("n_name").alias("nation"),
                 F.struct(F.col("r_name").alias("region_name")).alias("region")).alias("home"),
        engines.alias("main_engines"),
        aux.alias("aux_engines"),
        F.split("c_name", "#").alias("tags"),
    )
    active = (
        F.when(F.col("c_mktsegment") == "MACHINERY", "")
        .when(F.col("c_mktsegment") == "BUILDING", '"active":null,')
        .otherwise(F.concat(F.lit('"active":'), (F.col("c_acctbal") >= 0).cast("string"), F.lit(",")))
    )
    raw = F.concat(F.lit('[{"imo":"'), _imo("c_custkey"), F.lit('",'), active, F.lit('"data":'),
                   F.to_json(data), F.lit("}]"))
    return ships.select(F.lit("ShipData").alias("entity"), F.lit(None).cast("string").alias("imo"),
                        F.lit("2024/01/31/00/00").alias("loaddate"), raw.alias("raw"))


def wide_tele(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two readings per order line: 10 ships, 218 signals, 5-minute grid (1.2 million rows at sf0.1)."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        F.posexplode(F.array("l_quantity", "l_extendedprice")).alias("reading", "value"),
    )
    load = F.timestamp_seconds(F.lit(1704067200) + F.col("l_linenumber") * 3600)
    return lines.select(
        _mod_imo("l_suppkey").alias("imo"),
        F.concat(F.lit("sig_"), ((F.col("l_partkey") * 2 + F.col("reading")) % 218).cast("string")).alias("signal"),
        F.timestamp_seconds(F.lit(1704067200) + (F.col("l_orderkey") % 1150) * 300).alias("signal_timestamp"),
        F.when(F.col("value") >= 5, F.col("value")).alias("signal_value"),
        F.date_format(load, LOADDATE_FORMAT).alias("loaddate"),
        (F.col("l_orderkey") * 16 + F.col("l_linenumber") * 2 + F.col("reading")).alias("event_id"),
    )


def _mod_imo(column: str):
    return (F.lit(9000000) + F.col(column) % 10).cast("string")
