"""Keyed upserts and schema evolution on plain Parquet tables.

The target is large, the source is one load. The source is staged first (computed once, then
checked, measured and joined from there). While its keys are few, the target is filtered by broadcast
and never shuffled; a larger source uses a shuffle join. Keys are unique on both sides, so no key is
hot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetframe import scale, schemas
from fleetframe.functions import exact
from fleetframe.session import materialize


class DuplicateKeyError(ValueError):
    """A source key occurs more than once, so the row to take is undefined."""


def stage(source: DataFrame) -> DataFrame:
    """The load as a staging table."""
    return materialize(source)


def check_unique(source: DataFrame, keys: list[str]) -> None:
    """Fail if a (non-null) key repeats."""
    known = source.dropna(subset=keys)
    repeated = known.groupBy(*[exact(k) for k in keys]).count().filter("count > 1")
    example = repeated.first()
    if example is not None:
        raise DuplicateKeyError(f"source key occurs {example['count']} times: {example.asDict()}")


def merge_upsert(target: DataFrame, source: DataFrame, keys: list[str], check: bool = True,
                 limit: int = scale.BROADCAST_BYTES) -> DataFrame:
    """Matched rows take all columns of the source, unmatched source rows are added.

    Columns that only the target has keep the target's value.
    """
    source = stage(source)
    if check:
        check_unique(source, keys)
    untouched = scale.without_keys(target, source, keys, limit)
    kept = [c for c in target.columns if c not in source.columns]
    loaded = _with_old_values(source, target, keys, kept, limit) if kept else source
    return untouched.unionByName(loaded, allowMissingColumns=True)


def missing_columns(target: DataFrame, source: DataFrame) -> list[str]:
    return sorted(c for c in source.columns if c not in target.columns)


def evolve(target: DataFrame, source: DataFrame) -> DataFrame:
    """Add the source's new signal columns to the target as nullable DOUBLE, sorted by name."""
    added = [F.lit(None).cast("double").alias(c) for c in missing_columns(target, source)]
    return target.select("*", *added)


def pivot_upsert(target: DataFrame, source: DataFrame, keys: list[str] = schemas.PIVOT_KEY,
                 ignore_null: bool = False, check: bool = True, limit: int = scale.BROADCAST_BYTES,
                 staged: bool = False) -> DataFrame:
    """Upsert wide rows: matched rows take every source column, null included; unmatched are added.

    Columns only the target has keep the target's value; columns only the source has are added.
    With `ignore_null`, a null in the source does not overwrite. `staged` says that the source is
    a stored table already.

    A stored row is either passed on as it is or replaced, so the many columns of the target are not
    compared one by one; old values are fetched only for the columns that need them.
    """
    source = source if staged else stage(source)
    if check:
        check_unique(source, keys)
    untouched = scale.without_keys(target, source, keys, limit)
    kept = [c for c in target.columns if c not in keys and (ignore_null or c not in source.columns)]
    loaded = _with_old_values(source, target, keys, kept, limit) if kept else source
    return evolve(untouched, source).unionByName(loaded, allowMissingColumns=True)


def _with_old_values(source: DataFrame, target: DataFrame, keys: list[str], kept: list[str], limit: int) -> DataFrame:
    """Source rows with the stored values of `kept` where the source has none."""
    stored = scale.of_keys(target.select(*[exact(c) for c in [*keys, *kept]]), source, keys, limit)
    old = stored.select(*[exact(k) for k in keys], *[exact(c).alias(f"old:{c}") for c in kept])
    values = [F.coalesce(exact(c), exact(f"old:{c}")).alias(c) if c in kept else exact(c) for c in source.columns]
    added = [exact(f"old:{c}").alias(c) for c in kept if c not in source.columns]
    return source.join(old, keys, "left").select(*values, *added)
