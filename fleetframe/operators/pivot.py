"""Signals to columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetframe import schemas
from fleetframe.functions import exact

LOAD_INDEX = ["imo", "signal_timestamp", "loaddate"]


def distinct_signals(df: DataFrame) -> DataFrame:
    return df.select("signal").distinct()


def signal_list(df: DataFrame) -> list[str]:
    """Sorted signal names, the columns of the pivot. A table cannot have more than the pivot limit."""
    limit = int(df.sparkSession.conf.get("spark.sql.pivotMaxValues"))
    names = [row.signal for row in distinct_signals(df).filter(F.col("signal").isNotNull()).take(limit + 1)]
    if len(names) > limit:
        raise ValueError(f"more than {limit} signals; raise spark.sql.pivotMaxValues or select signals first")
    return sorted(names)


def signal_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("signal").agg(F.count(F.lit(1)).alias("count"))


def top_signals(df: DataFrame, k: int) -> DataFrame:
    """The k most frequent signals; ties by name."""
    return signal_counts(df).orderBy(F.desc("count"), "signal").limit(k)


def keep_top_signals(df: DataFrame, k: int) -> DataFrame:
    """Rows of the k most frequent signals (all rows if there are no more than k)."""
    return df.join(F.broadcast(top_signals(df, k).select("signal")), "signal", "left_semi")


def pivot_long(df: DataFrame, signals: list[str] | None = None, index: list[str] = LOAD_INDEX,
               unique: bool = False, on_duplicate: str = "max") -> DataFrame:
    """One row per index, one column per signal (sorted), for a table of any number of signals.

    Cells are reduced first, on the map side too, so repeated loads of a point do not pile up. The
    narrow cells are then placed by index; wide rows are built where they stay. Spreading the cells
    any other way would ship a full row of columns per cell. `unique` says that the cells are
    already unique (after `latest_wins`). `on_duplicate="error"` fails on a cell with two rows.
    """
    signals = sorted(signals) if signals is not None else signal_list(df)
    rows = df.filter(F.col("signal").isin(signals)).select(*index, "signal", "signal_value")
    cells = rows if unique else _cells(rows, [*index, "signal"], on_duplicate)
    placed = cells.repartition(*index)
    return placed.groupBy(*index).pivot("signal", signals).agg(F.max("signal_value"))


def pivot_latest(latest: DataFrame, signals: list[str] | None = None) -> DataFrame:
    """Wide table keyed by (imo, signal_timestamp), loaddate = newest of the row's cells.

    Expects one row per cell (`latest_wins`), so a key holds at most one row per signal.
    """
    key = schemas.PIVOT_KEY
    signals = sorted(signals) if signals is not None else signal_list(latest)
    rows = latest.filter(F.col("signal").isin(signals)).select(*key, "loaddate", "signal", "signal_value")
    newest = F.max("loaddate").over(Window.partitionBy(*reversed(key)))
    placed = rows.repartition(*key).withColumn("loaddate", newest)
    return placed.groupBy(*key, "loaddate").pivot("signal", signals).agg(F.max("signal_value"))


def pivot_conditional(df: DataFrame, signals: list[str] | None = None, index: list[str] = LOAD_INDEX) -> DataFrame:
    """The same table by conditional aggregation: one shuffle, for a handful of signals."""
    signals = sorted(signals) if signals is not None else signal_list(df)
    value = [F.max(F.when(F.col("signal") == s, F.col("signal_value"))).alias(s) for s in signals]
    return df.filter(F.col("signal").isin(signals)).groupBy(*index).agg(*value)


def unpivot(wide: DataFrame, index: list[str] = LOAD_INDEX) -> DataFrame:
    """Wide table back to long rows, without empty cells."""
    signals = [c for c in wide.columns if c not in LOAD_INDEX]
    long = wide.unpivot(list(index), [exact(s) for s in signals], "signal", "signal_value")
    return long.filter(F.col("signal_value").isNotNull())


def pivot_stats(wide: DataFrame) -> DataFrame:
    """Rows, columns, distinct ships and time range of a wide table."""
    return wide.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.lit(len(wide.columns)).cast("long").alias("n_columns"),
        F.countDistinct("imo").alias("n_ships"),
        F.min("signal_timestamp").alias("first_timestamp"),
        F.max("signal_timestamp").alias("last_timestamp"),
    )


def _cells(rows: DataFrame, key: list[str], on_duplicate: str) -> DataFrame:
    value = F.max("signal_value")
    if on_duplicate == "error":
        value = F.when(F.count(F.lit(1)) > 1, F.raise_error(F.lit("several rows for one cell"))).otherwise(value)
    elif on_duplicate != "max":
        raise ValueError("on_duplicate must be 'max' or 'error'")
    return rows.groupBy(*key).agg(value.cast("double").alias("signal_value"))
