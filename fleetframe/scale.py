"""Joins with a smaller side: broadcast it after measuring it, otherwise salt the larger side's hot keys."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetframe.functions import exact
from fleetframe.session import materialize

BROADCAST_BYTES = 64 * 1024 * 1024
SALTS = 64
HOT_ROWS = 1_000

_FIXED_WIDTH = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)


def measured_bytes(df: DataFrame) -> int | None:
    """Measured size of a flat frame (one aggregation, one row back); None if it has nested columns."""
    strings = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    fixed = [f.name for f in df.schema if isinstance(f.dataType, _FIXED_WIDTH)]
    if len(strings) + len(fixed) < len(df.columns):
        return None
    text = reduce(Column.__add__, [F.coalesce(F.octet_length(exact(c)), F.lit(0)) for c in strings], F.lit(0))
    rows, chars = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(text.cast("long")), F.lit(0))).first()
    return rows * 16 * max(len(df.columns), 1) + chars


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    size = measured_bytes(df)
    return size is not None and size <= limit


def semi_join(df: DataFrame, keys_df: DataFrame, keys: list[str], limit: int = BROADCAST_BYTES) -> DataFrame:
    """Rows of `df` whose key is in `keys_df`; `df` is not shuffled while the key list is small.

    The distinct keys are computed once, measured, and joined from their checkpoint.
    """
    return _keyed_join(df, keys_df, keys, "left_semi", limit)


def anti_join(df: DataFrame, keys_df: DataFrame, keys: list[str], limit: int = BROADCAST_BYTES) -> DataFrame:
    """Rows of `df` whose key is not in `keys_df`; a null key matches nothing and is kept."""
    return _keyed_join(df, keys_df, keys, "left_anti", limit)


def without_keys(target: DataFrame, source: DataFrame, keys: list[str], limit: int = BROADCAST_BYTES) -> DataFrame:
    """Rows of a large `target` that a small `source` does not touch. Keys are unique in `target`."""
    return target.join(_small_keys(source, keys, limit), keys, "left_anti")


def of_keys(target: DataFrame, source: DataFrame, keys: list[str], limit: int = BROADCAST_BYTES) -> DataFrame:
    """Rows of a large `target` that a small `source` touches. Keys are unique in `target`."""
    return target.join(_small_keys(source, keys, limit), keys, "left_semi")


def not_in_target(source: DataFrame, target: DataFrame, keys: list[str], limit: int = BROADCAST_BYTES) -> DataFrame:
    """Rows of a small `source` whose key a large `target` does not have.

    The target's keys are first reduced to those of the source, so the target is never shuffled
    while the source is small. Keys are unique in `target`.
    """
    known = of_keys(target.select(*[exact(k) for k in keys]), source, keys, limit)
    return source.join(known, keys, "left_anti")


def _small_keys(source: DataFrame, keys: list[str], limit: int) -> DataFrame:
    wanted = source.select(*[exact(k) for k in keys])
    return F.broadcast(wanted) if fits_broadcast(wanted, limit) else wanted


def left_join(df: DataFrame, small: DataFrame, keys: list[str], limit: int = BROADCAST_BYTES,
              salts: int = SALTS) -> DataFrame:
    """Left equi join, bag semantics (several matches fan out). `small` is computed once."""
    small = materialize(small)
    if fits_broadcast(small, limit):
        return df.join(F.broadcast(small), keys, "left")
    return _salted_join(df, small, keys, "left", salts)


def _keyed_join(df: DataFrame, keys_df: DataFrame, keys: list[str], how: str, limit: int) -> DataFrame:
    wanted = materialize(keys_df.select(*[exact(k) for k in keys]).distinct())
    if fits_broadcast(wanted, limit):
        return df.join(F.broadcast(wanted), keys, how)
    return _salted_join(df, wanted, keys, how, SALTS)


def _salted_join(df: DataFrame, small: DataFrame, keys: list[str], how: str, salts: int) -> DataFrame:
    """Shuffled join in which only keys that are hot in `df` are salted.

    The keys of `df` are counted (combined on the map side). A key with more than 1/(16 * salts) of the
    rows is hot, so there are less than 16 * salts hot keys; their rows are spread over `salts`
    partitions and only their rows of the small side are repeated. The salt is a hash of the row and of
    the task's partition number, not a random number, so a recomputed task sends each row to the same
    place; the partition number also spreads equal copies.
    """
    hot = _hot_keys(df, keys, salts)
    flagged = (frame.join(F.broadcast(hot), keys, "left").fillna(False, "_hot") for frame in (df, small))
    left, right = flagged
    rest = [exact(c) for c in df.columns if c not in keys]
    spread = F.pmod(F.xxhash64(*rest, F.spark_partition_id()), F.lit(salts)).cast("int")
    alone = reduce(Column.__or__, [exact(k).isNull() for k in keys])  # matches nothing, wherever it goes
    left = left.withColumn("_salt", F.when(F.col("_hot") | alone, spread).otherwise(F.lit(0))).drop("_hot")
    copies = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    right = right.withColumn("_salt", F.explode(copies)).drop("_hot")
    return left.join(right, [*keys, "_salt"], how).drop("_salt")


def _hot_keys(df: DataFrame, keys: list[str], salts: int) -> DataFrame:
    """(keys, _hot): keys with more than 1/(16 * salts) of all rows and at least 1,000 of them."""
    counts = materialize(df.groupBy(*[exact(k) for k in keys]).agg(F.count(F.lit(1)).alias("_rows")))
    total = counts.agg(F.coalesce(F.sum("_rows"), F.lit(0))).first()[0]
    least = max(HOT_ROWS, total / (16 * salts))
    return materialize(counts.filter(F.col("_rows") > least).select(*[exact(k) for k in keys], F.lit(True).alias("_hot")))
