"""Connected components by alternating large-star and small-star steps over an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetframe.llm.common import few, gathered, staged, unstage


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of `edges` (a, b): the component is its smallest node.

    Each step is an aggregation with partial sums and a join that adaptive execution can split, so a node
    with very many links does not gather them in one task. Steps are written to the shared folder, each goes when the
    next one stands; the last stays staged. Steps over a table that is small on disk are written by a few tasks, whatever
    the number of shuffle partitions: many such steps would else be little but starts of tasks.
    """
    current = staged(_ordered(edges.select(F.col("a").alias("low"), F.col("b").alias("high"))), "edges")
    while not _stars(current):
        small = few(current)
        both = current.select(F.col("low").alias("u"), F.col("high").alias("v")).union(current.select("high", "low"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("u", "m").alias("m"))
        large = both.where("v > u").join(_side(least, small), F.col("u") == F.col("w"))
        large = _ordered(large.select(F.col("m").alias("low"), F.col("v").alias("high"))).distinct()
        large, last = staged(gathered(large, small), "edges"), current
        unstage(last)
        least = large.groupBy("high").agg(F.min("low").alias("m")).withColumnRenamed("high", "w")
        moved = large.join(_side(least, small), F.col("high") == F.col("w"))
        least = gathered(least, small).select("m", "w")
        joined = moved.select(F.col("m").alias("low"), F.col("low").alias("high")).union(least)
        current = staged(gathered(_ordered(joined).distinct(), small), "edges")
        unstage(large)
    roots = current.select("low").distinct().select(F.col("low").alias("node"), F.col("low").alias("component"))
    return current.select(F.col("high").alias("node"), F.col("low").alias("component")).union(roots)


def _stars(edges: DataFrame) -> bool:
    """Whether every node is either the smaller end of its edges or the greater end of its only one: no step changes that."""
    ends = edges.select(F.col("low").alias("node"), F.lit(0).alias("upper")).union(edges.select("high", F.lit(1)))
    nodes = gathered(ends.groupBy("node").agg(F.sum("upper").alias("upper"), F.count(F.lit(1)).alias("n")), few(edges))
    return not nodes.agg(F.max((F.col("upper") > 0) & (F.col("n") > 1))).first()[0]


def _side(least: DataFrame, small: bool) -> DataFrame:
    return F.broadcast(gathered(least, True)) if small else least


def _ordered(edges: DataFrame) -> DataFrame:
    pair = edges.select(F.least("low", "high").alias("low"), F.greatest("low", "high").alias("high"))
    return pair.where("low < high")
