"""Mergeable statistics of runs: one row of sketches per run, merged over any days without opening the runs again.

Counts of rows and the first and last time are exact. Distinct ships, series and points come from HyperLogLog sketches,
quantiles of the values from KLL sketches; both are combined on the map side, so a hot ship or run costs one sketch per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetframe.operators.dedup import POINT_KEY

# Size of the sketches. With 2^12 buckets the standard error of a distinct count is 1.6 %; the rank error of a quantile
# with k = 200 is 1.65 % at a confidence of 99 %.
LG_BUCKETS, QUANTILE_K = 12, 200
COUNT_ERROR, RANK_ERROR = 0.016, 0.0165

DISTINCT = {"ships": ["imo"], "series": ["imo", "signal"], "points": POINT_KEY}


def _key(columns: list[str]) -> Column:
    """A number for the values of the columns; nulls count as values."""
    return F.xxhash64(*[F.struct(F.col(c).isNull().alias("missing"), F.col(c)) for c in columns])


def run_sketches(rows: DataFrame, by: list[str]) -> DataFrame:
    """One row per run (the columns `by`): n_rows, n_values, first, last, and a sketch per entry of DISTINCT and of the values."""
    distinct = [F.hll_sketch_agg(_key(columns), LG_BUCKETS).alias(f"{name}_sketch") for name, columns in DISTINCT.items()]
    return rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("signal_value").alias("n_values"),
        F.min("signal_timestamp").alias("first"), F.max("signal_timestamp").alias("last"),
        *distinct, F.kll_sketch_agg_double("signal_value", QUANTILE_K).alias("values_sketch"))


def merge_sketches(sketches: DataFrame, by: list[str] | None = None) -> DataFrame:
    """The statistics of several runs as one row (per `by`), from their rows alone; may be merged again."""
    return sketches.groupBy(*(by or [])).agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n_values").alias("n_values"), F.min("first").alias("first"), F.max("last").alias("last"),
        *[F.hll_union_agg(f"{name}_sketch").alias(f"{name}_sketch") for name in DISTINCT],
        F.kll_merge_agg_double("values_sketch").alias("values_sketch"))


def estimates(sketches: DataFrame, quantiles: tuple[float, ...] = (0.05, 0.5, 0.95)) -> DataFrame:
    """The sketches as numbers: `ships`, `series`, `points` and an array `quantiles` (null without values)."""
    made = {name: F.hll_sketch_estimate(f"{name}_sketch") for name in DISTINCT}
    ranks = [F.kll_sketch_get_quantile_double("values_sketch", F.lit(q)) for q in quantiles]
    made["quantiles"] = F.when(F.col("n_values") > 0, F.array(*ranks))
    return sketches.withColumns(made).drop(*[f"{name}_sketch" for name in DISTINCT], "values_sketch")
