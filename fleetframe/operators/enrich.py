"""Readable signal names and restriction to known ships."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetframe import scale, schemas
from fleetframe.operators.dedup import combine, first_wins


def mapping_nonnull(catalog: DataFrame) -> DataFrame:
    return catalog.filter(F.col("friendly_name").isNotNull())


def enrich_global(long: DataFrame, catalog: DataFrame, **join_options) -> DataFrame:
    """Left join on the signal alone; a signal with several names fans out."""
    names = mapping_nonnull(catalog).select("signal", "friendly_name").distinct()
    return scale.left_join(long, names, ["signal"], **join_options)


def enrich_per_ship(long: DataFrame, catalog: DataFrame, **join_options) -> DataFrame:
    """Left join on ship and signal, fixed column order; further columns follow."""
    names = mapping_nonnull(catalog).select("imo", "signal", "friendly_name").distinct()
    joined = scale.left_join(long.drop("friendly_name"), names, ["imo", "signal"], **join_options)
    return ordered_columns(joined)


def reenrich(table: DataFrame, catalog: DataFrame) -> DataFrame:
    """Backfill: stored long rows joined again with the current mapping."""
    return enrich_per_ship(table, catalog)


def ordered_columns(df: DataFrame) -> DataFrame:
    first = [c for c in schemas.LONG_COLUMNS if c in df.columns]
    return df.select(*first, *[c for c in df.columns if c not in first])


def restrict_to_active(df: DataFrame, ships: DataFrame) -> DataFrame:
    """Rows of known ships only."""
    return scale.semi_join(df, ships, ["imo"])


def update_mapping(current: DataFrame, new: DataFrame) -> DataFrame:
    """Union of known and new (imo, signal, friendly_name); the mapping only grows."""
    columns = ["imo", "signal", "friendly_name"]
    return combine([current.select(*columns), new.select(*columns)]).dropDuplicates(columns)


def catalog_first_wins(signals: DataFrame, order: list[Column | str]) -> DataFrame:
    """One definition per signal: the first in the given order."""
    return first_wins(signals, ["signal"], order)
