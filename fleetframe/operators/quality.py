"""Filters, payload quarantine, run audit and row counts."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from fleetframe.functions import elements, load_day, payload_status


def measurements(df: DataFrame) -> DataFrame:
    return df.filter(F.col("signal_value").isNotNull())


def gap_points(df: DataFrame) -> DataFrame:
    """Null measurements; each is the start of a possible gap."""
    return df.filter(F.col("signal_value").isNull()).select(
        "imo", "signal", "signal_timestamp", "loaddate", F.col("signal_timestamp").alias("gap_start")
    )


def cutoff_day(as_of: date, history_days: int) -> str:
    """First day that no longer counts as history, in load-stamp form."""
    return (as_of - timedelta(days=history_days)).strftime("%Y/%m/%d")


def within_history(df: DataFrame, cutoff: str) -> DataFrame:
    """Rows loaded after the cutoff day; load stamps compare as strings, the cutoff day is out."""
    return df.filter(load_day("loaddate") > cutoff)


def by_tag(df: DataFrame, *tags: str) -> DataFrame:
    return df.filter(F.col("tag").isin(*tags))


def classify_payloads(payloads: DataFrame) -> DataFrame:
    """Add `status` (ok, error, empty, corrupt) and the error text `detail`."""
    first = F.try_element_at(elements(F.col("raw")), F.lit(1))
    status = payload_status(F.col("raw"))
    return payloads.withColumn("status", status).withColumn(
        "detail", F.when(F.col("status") == "error", F.get_json_object(first, "$.detail"))
    )


def split_errors(payloads: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good payloads, quarantine). One bad payload never stops the others."""
    marked = classify_payloads(payloads)
    good = marked.filter(F.col("status") == "ok").drop("status", "detail")
    return good, marked.filter(F.col("status") != "ok")


def run_audit(classified: DataFrame) -> DataFrame:
    """One row per run: ships and calls, total, good and failed. Error texts: see `run_errors`."""
    ok = F.col("status") == "ok"
    answered = F.col("status").isin("ok", "error")
    per_ship = classified.groupBy("loaddate", "imo").agg(
        F.count(F.lit(1)).alias("calls"),
        F.count_if(answered).alias("answered"),
        F.bool_or(ok).alias("processed"),
    )
    runs = per_ship.groupBy("loaddate").agg(
        F.count("imo").alias("ships_total"),
        F.count_if("processed").alias("ships_processed"),
        F.count_if(~F.col("processed")).alias("ships_failed"),
        F.sum("calls").alias("calls_total"),
        F.sum("answered").alias("calls_success"),
        F.sum(F.col("calls") - F.col("answered")).alias("calls_failed"),
    )
    return runs.withColumn("success", F.col("ships_failed") == 0)


def run_errors(classified: DataFrame) -> DataFrame:
    """One row per failed payload (a list per run could hold most of a bad run in one value)."""
    bad = classified.filter(F.col("status") != "ok")
    return bad.select("loaddate", "imo", "status", F.coalesce("detail", F.concat(F.lit("payload is "), "status")).alias("message"))


def stage_counts(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows loaded, non-null and left after deduplication, in one aggregation over the keys."""
    value = F.col("signal_value")
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.count(value).alias("n_values"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("loaded"),
        F.coalesce(F.sum("n_values"), F.lit(0)).alias("non_null"),
        F.count_if(F.col("n_values") > 0).alias("deduplicated"),
    )


def observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Count the rows passing this point while the surrounding job runs; read `.get` afterwards."""
    observation = Observation(name)
    return df.observe(observation, F.count(F.lit(1)).alias("rows")), observation
