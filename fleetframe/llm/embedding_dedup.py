"""Embedding near-dedup with spherical-cap filters from random product codes.

A filter is a unit direction; a vector passes it if its projection reaches a threshold. The directions are
all combinations of one code word per block of the (randomly rotated) coordinates, so a vector's filters
are list-decoded from a few scores per block without looking at the rest. Vectors that share a filter
are compared exactly. Threshold and number of filters follow from the number of vectors and the cosine:
a vector meets few strangers in a filter, and two vectors at the cosine share SHARED filters on average.
The filters of a product code are not independent, so there are several tables with codes of their own.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetframe.llm.common import map_arrow, read, row_key, staged
from fleetframe.llm.components import components

COSINE = 0.9
SHARED = 6.0
STRANGERS = 2.0
LEAST_ROWS = 2_000
MAX_CODE = 4096
#: Highest share of pairs at the cosine that may miss each other in all tables, and pairs tried to measure it.
MISSED = 1e-3
TRIED = 400


def _marginal(grid: np.ndarray, dims: int) -> np.ndarray:
    """Share of the unit sphere by one coordinate, on an even grid over -1 to 1."""
    weight = np.maximum(1.0 - grid * grid, 0.0) ** max(0.0, (dims - 3) / 2)
    return weight / weight.sum()


def _width(dims: int) -> int:
    """Coordinates after padding: a power of two."""
    return max(4, 1 << (dims - 1).bit_length())


@lru_cache(maxsize=32)
def filter_plan(dims: int, rows: int, cosine: float = COSINE) -> tuple[float, int, int, int]:
    """Threshold, blocks, code words per block and number of tables for `rows` vectors of `dims` coordinates.

    A filter holds STRANGERS of `rows` random vectors, but is never so narrow that of two vectors at the
    cosine the second seldom passes where the first does. The number of tables follows from the share
    of such pairs that one table misses, measured on TRIED random ones.
    """
    width, grid = _width(dims), np.linspace(-1.0, 1.0, 8001)
    mass, rest = _marginal(grid, width), _marginal(grid, width - 1)
    above, rest_above = mass[::-1].cumsum()[::-1], np.append(rest[::-1].cumsum()[::-1], 0.0)

    def both(at: int) -> float:
        t = grid[at:]
        needed = (t[0] - cosine * t) / np.maximum(math.sqrt(max(1 - cosine * cosine, 0.0)) * np.sqrt(np.maximum(1 - t * t, 0.0)), 1e-12)
        spot = np.clip(np.ceil((np.clip(needed, -1.0, 1.001) + 1) * 4000), 0, 8001).astype(int)
        return float((mass[at:] * rest_above[spot]).sum())

    at = min(int(np.searchsorted(-above, -STRANGERS / max(rows, LEAST_ROWS))), len(grid) - 2)
    while at > 4000 and both(at) < 0.05 * above[at]:
        at -= 10
    filters = max(1.0, SHARED / both(at))
    blocks = 1
    while filters ** (1 / blocks) > MAX_CODE and 8 * blocks <= width:
        blocks *= 2
    plan = float(grid[at]), blocks, max(2, math.ceil(filters ** (1 / blocks)))

    made = np.random.Generator(np.random.PCG64([dims, rows]))
    first, other = made.standard_normal((2, TRIED, dims))
    first /= np.linalg.norm(first, axis=1, keepdims=True)
    other -= (other * first).sum(axis=1, keepdims=True) * first
    other /= np.maximum(np.linalg.norm(other, axis=1, keepdims=True), 1e-12)
    second = cosine * first + math.sqrt(max(1 - cosine * cosine, 0.0)) * other
    own = CapFilters(dims, plan, 0)
    missed = sum(not np.intersect1d(a, b).size for a, b in zip(own.decode(first), own.decode(second), strict=True))
    return *plan, max(1, math.ceil(math.log(MISSED) / math.log((missed + 1) / (TRIED + 2))))


class CapFilters:
    """The rotation and the product code of one table."""

    def __init__(self, dims: int, plan: tuple[float, int, int], table: int):
        self.threshold, self.blocks, words = plan
        self.width = _width(dims)
        made = np.random.Generator(np.random.PCG64([dims, words, table]))
        self.signs = made.choice([-1.0, 1.0], size=(2, self.width))
        code = made.standard_normal((self.blocks, words, self.width // self.blocks))
        self.code = code / np.linalg.norm(code, axis=2, keepdims=True) / math.sqrt(self.blocks)

    def _rotate(self, vectors: np.ndarray) -> np.ndarray:
        """Two rounds of random signs and a Hadamard transform."""
        out = np.zeros((len(vectors), self.width))
        out[:, :vectors.shape[1]] = vectors
        for signs in self.signs:
            out *= signs
            step = 1
            while step < self.width:
                pairs = out.reshape(len(out), -1, 2, step)
                out = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(len(out), -1)
                step *= 2
            out /= math.sqrt(self.width)
        return out

    def decode(self, units: np.ndarray) -> list[np.ndarray]:
        """For each unit vector the numbers of all filters that it passes, its best one at least."""
        rotated = self._rotate(units).reshape(len(units), self.blocks, -1)
        scores = np.einsum("nbd,bwd->nbw", rotated, self.code)
        words = self.code.shape[1]
        lists = []
        for own in scores:
            best = own.max(axis=1)
            threshold = min(self.threshold, best.sum() - 1e-12)
            ahead = np.append(best[::-1].cumsum()[::-1], 0.0)
            sums, ids = np.zeros(1), np.zeros(1, dtype=np.int64)
            for block, score in enumerate(own):
                order = np.argsort(-score)
                falling = score[order]
                # Of a partial sum, only the words that can still reach the threshold with the best of the rest.
                counts = np.searchsorted(-falling, sums - (threshold - ahead[block + 1]), side="right")
                which = np.repeat(np.arange(len(sums)), counts)
                place = np.arange(len(which)) - np.repeat(counts.cumsum() - counts, counts)
                sums, ids = sums[which] + falling[place], ids[which] * words + order[place]
            lists.append(np.sort(ids))
        return lists


@lru_cache(maxsize=8)
def cap_filters(dims: int, rows: int, cosine: float) -> list[CapFilters]:
    """All tables for vectors of one length."""
    *plan, tables = filter_plan(dims, rows, cosine)
    return [CapFilters(dims, tuple(plan), table) for table in range(tables)]


def filters_of(units: np.ndarray, rows: int, cosine: float) -> list[np.ndarray]:
    """For each unit vector its filters in all tables, numbered apart."""
    tables = cap_filters(units.shape[1], rows, cosine)
    lists = [[ids * len(tables) + t for ids in table.decode(units)] for t, table in enumerate(tables)]
    return [np.concatenate(own) for own in zip(*lists, strict=True)]


def with_filters(classes: DataFrame, rows: int, cosine: float) -> DataFrame:
    """(id, dims, filters) of classes (id, vector); `vector` is finite and not zero."""
    schema = "id long, dims long, filters array<long>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                vectors = [np.asarray(v, dtype=np.float64) for v in part.column("vector").to_pylist()]
                found: list[np.ndarray] = [np.zeros(0)] * len(vectors)
                for dims in {len(v) for v in vectors}:
                    at = [i for i, v in enumerate(vectors) if len(v) == dims]
                    own = np.stack([vectors[i] for i in at])
                    own = own / np.abs(own).max(axis=1, keepdims=True)
                    lists = filters_of(own / np.linalg.norm(own, axis=1, keepdims=True), rows, cosine)
                    for i, ids in zip(at, lists, strict=True):
                        found[i] = ids
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array([len(v) for v in vectors], pa.int64()), pa.array(found, pa.list_(pa.int64()))],
                    names=["id", "dims", "filters"])

    return map_arrow(classes.select("id", "vector"), run, schema)


def class_links(classes: DataFrame, rows: int, cosine: float) -> DataFrame:
    """(a, b): classes whose vectors have at least the cosine, a < b, found through a common filter."""
    filters = staged(with_filters(classes, rows, cosine), "filters")
    spread = filters.select("id", "dims", F.explode("filters").alias("filter"))
    left, right = (spread.select(*[F.col(c).alias(f"{c}_{side}") for c in spread.columns]) for side in "ab")
    same = (F.col("filter_a") == F.col("filter_b")) & (F.col("dims_a") == F.col("dims_b")) & (F.col("id_a") < F.col("id_b"))
    pairs = left.join(right, same).select(F.col("id_a").alias("a"), F.col("id_b").alias("b")).distinct()
    # Divided by the power of two below the greatest component, which is exact: squares neither vanish nor overflow.
    scale = F.pow(F.lit(2.0), F.floor(F.log2(F.array_max(F.transform("vector", F.abs)))))
    scaled = classes.withColumn("scale", scale).select("id", F.transform("vector", lambda x: x / F.col("scale")).alias("vector"))
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x))
    normed = scaled.select("id", "vector", norm.alias("norm"))
    a, b = (normed.select(F.col("id").alias(s), F.col("vector").alias(f"v{s}"), F.col("norm").alias(f"n{s}")) for s in "ab")
    dot = F.aggregate(F.zip_with("va", "vb", lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    return pairs.join(a, "a").join(b, "b").where(dot / (F.col("na") * F.col("nb")) >= cosine).select("a", "b")


def near_duplicates(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", cosine: float = COSINE) -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row per row of `vectors`.

    Equal vectors are one class: they link with each other and are compared with others once. Rows link with
    nothing whose vector is null, empty, zero or not finite, or whose id is null (component null, kept).
    Vectors of different length do not link. Rows that share an id are one node with their links added up. Ids are of any
    type with an order.
    """
    source = vectors.select(F.col(vec_id).alias("vec_id"),
                            F.col(embedding).cast("array<double>").alias("vector"))
    usable = (F.col("vec_id").isNotNull() & (F.size("vector") > 0)
              & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
              & F.exists("vector", lambda x: x != 0))
    rows = staged(source.where(F.coalesce(usable, F.lit(False)))
                  .withColumn("vector", F.transform("vector", lambda x: x + 0.0)).withColumn("digest", row_key("vector")), "vectors")
    classes = rows.groupBy("digest").agg(F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("copies"))
    lead = (rows.withColumnRenamed("vec_id", "id").join(classes, ["digest", "id"]).dropDuplicates(["digest"])
            .withColumnRenamed("digest", "class"))
    # Ids of classes must differ even if rows share an id.
    lead = staged(lead.select(F.xxhash64("class").alias("id"), "class", F.col("id").alias("lead"), "copies", "vector"), "classes")
    found = staged(class_links(lead.select("id", "vector"), lead.count(), cosine), "links")
    both = found.union(found.select("b", "a"))
    reached = (both.join(lead.select(F.col("id").alias("b"), F.col("copies").alias("more")), "b")
               .groupBy("a").agg(F.sum("more").alias("others")))
    named = lead.select("id", "lead")
    edges = (found.join(named.select(F.col("id").alias("a"), F.col("lead").alias("from")), "a")
             .join(named.select(F.col("id").alias("b"), F.col("lead").alias("to")), "b").select("from", "to"))
    member = rows.select("vec_id", F.xxhash64("digest").alias("id")).join(lead.select("id", "lead", "copies"), "id")
    copies = member.where("vec_id != lead").select(F.col("lead").alias("from"), F.col("vec_id").alias("to"))
    labels = components(edges.union(copies).select(F.col("from").alias("a"), F.col("to").alias("b")))
    counted = (member.join(reached, F.col("id") == F.col("a"), "left").groupBy("vec_id")
               .agg(F.sum(F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links")))
    out = (source.select("vec_id").join(counted, "vec_id", "left")
           .join(labels.withColumnRenamed("node", "vec_id"), "vec_id", "left"))
    own = F.coalesce("component", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), own.alias("component_id"),
                      F.coalesce(F.col("vec_id") == own, F.lit(True)).alias("kept"))


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "embeddings"))
