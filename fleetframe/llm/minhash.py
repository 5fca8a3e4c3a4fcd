"""MinHash near-dedup with min-max hashing.

Each permutation of the shingle hashes keeps its smallest and its greatest value, so 64 permutations give
a signature of 128 values. Bands of two permutations (four values) find candidates: at a similarity of
0.75 a pair shares none of the 32 bands with a probability of 5 in a million. That holds for large sets: in tiny
ones smallest and greatest value depend on each other, and 3 against 4 shingles are missed with 1 in 10,000.

Equal sets are one class from the start. A bucket does not emit its pairs: its most connected member, the
hub, is compared with the others, exactly. Only buckets that then still hold several components go
on: after a second hub their members take part in a prefix-filtered set join, which is exact.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fleetframe.llm.common import BROADCAST_BYTES, collect_plans, per_text, read, settled, staged, unstage, unused, worker_state
from fleetframe.llm.components import components

SHINGLE = 5
PERMUTATIONS = 64
BAND_PERMUTATIONS = 2
PERCENT = 75
ROUNDS = 2
WORD_CACHE = 100_000
_CHUNK = 2048
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


@lru_cache(maxsize=1)
def _permutations() -> tuple[np.ndarray, np.ndarray]:
    made = np.random.Generator(np.random.PCG64(7)).integers(0, 2**64, size=(2, PERMUTATIONS), dtype=np.uint64)
    return made[0] | np.uint64(1), made[1]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class Shingler:
    """Distinct 64-bit hashes of word shingles. A-Z is lowered; words end at ASCII white space."""

    def __init__(self):
        self.words: dict[bytes, int] = {}

    def shingles(self, text: str | None) -> np.ndarray:
        words = (text or "").encode().lower().split()
        if len(self.words) > WORD_CACHE:
            self.words.clear()
        known, digest = self.words, xxhash.xxh3_64_intdigest
        hashes = []
        for word in words:
            value = known.get(word)
            if value is None:
                value = known[word] = digest(word)
            hashes.append(value)
        codes = np.array(hashes, dtype=np.uint64)
        width = min(SHINGLE, len(codes))
        if not width:
            return codes
        rolled = np.full(len(codes) - width + 1, width, dtype=np.uint64)
        for i in range(width):
            rolled = rolled * _MULTIPLIER + codes[i:len(codes) - width + 1 + i]
        return np.unique(_mix(rolled))


def shingler() -> Shingler:
    """One per worker process."""
    return worker_state(("minhash",), Shingler)


def bands_of(shingles: np.ndarray) -> np.ndarray:
    """One 64-bit key per band of the min-max signature."""
    factor, shift = _permutations()
    low = np.full(PERMUTATIONS, 2**64 - 1, dtype=np.uint64)
    high = np.zeros(PERMUTATIONS, dtype=np.uint64)
    for start in range(0, len(shingles), _CHUNK):
        values = shingles[start:start + _CHUNK, None] * factor + shift
        np.minimum(low, values.min(axis=0), out=low)
        np.maximum(high, values.max(axis=0), out=high)
    signature = np.stack([low, high], axis=1).reshape(-1, 2 * BAND_PERMUTATIONS)
    keys = np.arange(len(signature), dtype=np.uint64)
    for column in signature.T:
        keys = _mix(keys * _MULTIPLIER + column)
    return keys.view(np.int64)


def signatures(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc_id, n_shingles, d1, d2, bands): the size and the 128-bit digest of the set, its band keys."""
    def worker(texts: list[str | None]) -> dict[str, list]:
        sizes, digests, bands = [], [], []
        for text in texts:
            shingles = shingler().shingles(text)
            sizes.append(len(shingles))
            digest = xxhash.xxh3_128_digest(shingles.tobytes())
            digests.append(np.frombuffer(digest, dtype=np.int64))
            bands.append(bands_of(shingles) if len(shingles) else np.zeros(0, dtype=np.int64))
        return {"n_shingles": sizes, "d1": [int(d[0]) for d in digests], "d2": [int(d[1]) for d in digests], "bands": bands}

    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return per_text(source, ["doc_id"], "text", "n_shingles long, d1 long, d2 long, bands array<long>", worker)


def _sets(docs: DataFrame, doc_id: str, text: str, wanted: DataFrame) -> DataFrame:
    """(id, shingles) of the documents whose id and digest are `wanted`; repeated rows may repeat here."""
    size = wanted.agg(F.sum(F.octet_length(F.col("id").cast("string")) + 32)).first()[0] or 0
    small = size <= BROADCAST_BYTES
    source = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    found = source.join(F.broadcast(wanted) if small else wanted, "id")

    def worker(texts: list[str | None]) -> dict[str, list]:
        sets = [shingler().shingles(t) for t in texts]
        digests = [np.frombuffer(xxhash.xxh3_128_digest(s.tobytes()), dtype=np.int64) for s in sets]
        return {"shingles": [s.view(np.int64) for s in sets], "own1": [int(d[0]) for d in digests], "own2": [int(d[1]) for d in digests]}

    made = per_text(found, ["id", "d1", "d2"], "text", "shingles array<long>, own1 long, own2 long", worker)
    return made.where("d1 = own1 AND d2 = own2").select("id", "shingles")


def _alike(common: Column, a: Column, b: Column, percent: int) -> Column:
    return 100 * common >= percent * (a + b - common)


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough; a pair may repeat if rows do.

    No aggregation follows the joins, so adaptive execution can split the rows of a hub.
    """
    first = sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa"))
    second = sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb"))
    common = F.size(F.array_intersect("sa", "sb"))
    return pairs.join(first, "a").join(second, "b").where(_alike(common, F.size("sa"), F.size("sb"), percent)).select("a", "b")


def _hub_pairs(members: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of each bucket's hub with the members whose size allows a link.

    The hub is the member that shares buckets with most others, the smallest id of equals. Rows that share an id have
    several sets, of `least` to `most` shingles.
    """
    best = F.min(F.struct((-F.col("degree")).alias("minus"), F.col("id").alias("hub"), F.col("least").alias("hub_least"), F.col("most").alias("hub_most")))
    hubs = members.groupBy("key").agg(best.alias("best")).select("key", "best.hub", "best.hub_least", "best.hub_most")
    possible = 100 * F.least("most", "hub_most") >= percent * F.greatest("least", "hub_least")
    return (members.join(hubs, "key").where((F.col("id") != F.col("hub")) & possible)
            .select(F.least("id", "hub").alias("a"), F.greatest("id", "hub").alias("b")).distinct())


def _prefix_pairs(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs of members of different components that the prefix filter leaves: no similar pair is lost.

    Of a set of n shingles ordered by rarity, the first n - ceil(n * percent / 100) + 1 must hold one that a
    similar set has in its own prefix; the first common one also bounds how much can follow.
    """
    own = sets.join(members, "id").dropDuplicates(["id"])
    tokens = own.select("id", "component", F.size("shingles").alias("n"), F.explode("shingles").alias("token"))
    counts = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    # A shingle of one set alone comes first in the order and joins with nothing.
    shared = tokens.join(counts, "token")
    alone = F.col("n") - F.count(F.lit(1)).over(Window.partitionBy("id"))
    place = alone + F.row_number().over(Window.partitionBy("id").orderBy("df", "token")) - 1
    prefix = shared.withColumn("place", place).where(F.col("place") <= F.col("n") - F.ceil(F.col("n") * percent / 100))
    left, right = (prefix.select("token", *[F.col(c).alias(f"{c}_{side}") for c in ("id", "component", "n", "place")])
                   for side in ("a", "b"))
    most = F.least(F.col("n_a") - F.col("place_a"), F.col("n_b") - F.col("place_b"))
    possible = ((F.col("id_a") < F.col("id_b")) & (F.col("component_a") != F.col("component_b"))
                & _alike(most, F.col("n_a"), F.col("n_b"), percent))
    return left.join(right, (left["token"] == right["token"]) & possible).select(F.col("id_a").alias("a"), F.col("id_b").alias("b")).distinct()


def links(docs: DataFrame, classes: DataFrame, doc_id: str, text: str, percent: int = PERCENT) -> DataFrame:
    """(a, b): links between class representatives that span the components of the similarity graph.

    `classes` has (id, n_shingles, d1, d2, bands), one row per distinct set.
    """
    keyed = classes.select("id", F.col("n_shingles").alias("n"), F.explode("bands").alias("key"))
    buckets = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    # A set is in 32 buckets at most.
    by_id = Window.partitionBy("id")
    members = staged(keyed.join(buckets, "key").select(
        "key", "id", F.min("n").over(by_id).alias("least"), F.max("n").over(by_id).alias("most"),
        F.sum(F.col("size") - 1).over(by_id).alias("degree")), "buckets")
    wanted = classes.select("id", "d1", "d2").join(members.select("id").distinct(), "id", "left_semi")
    sets = staged(_sets(docs, doc_id, text, wanted), "shingles")
    spark = docs.sparkSession
    collect_plans(spark)

    found, active, tested, before = None, members, None, None
    for _ in range(ROUNDS):
        pairs = _hub_pairs(active, percent)
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = staged(pairs, "pairs")
        tested = pairs if tested is None else tested.union(pairs)
        linked = staged(_verified(pairs, sets, percent), "links")
        collect_plans(spark)
        found = linked if found is None else found.union(linked)
        labels = components(found).select(F.col("node").alias("id"), "component")
        labelled = members.join(labels, "id", "left").withColumn("component", F.coalesce("component", "id"))
        mixed = labelled.groupBy("key").agg(F.min("component").alias("one"), F.max("component").alias("other")).where("one < other")
        labelled = staged(labelled.join(mixed.select("key"), "key"), "mixed")
        collect_plans(spark)
        if before is not None:
            unstage(before)
        before = labelled
        if labelled.isEmpty():
            return found
        # The next hub stands for the components other than that of the bucket's largest part.
        sizes = labelled.groupBy("key", "component").agg(F.count(F.lit(1)).alias("n"))
        largest = sizes.groupBy("key").agg(F.max(F.struct("n", "component")).alias("top")).select("key", F.col("top.component").alias("main"))
        active = labelled.join(largest, "key").where("component != main").select(*members.columns)
    rest = labelled.select("id", "component").distinct()
    pairs = _prefix_pairs(rest, sets, percent).join(tested, ["a", "b"], "left_anti")
    return found.union(staged(_verified(pairs, sets, percent), "links"))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row per row of `docs`.

    Null and empty texts have no shingles and are alone; so are rows without id (component null, kept).
    Rows that share an id are one node. `kept` marks the smallest id of each component. Ids are of any type with an order.
    """
    signed = staged(signatures(docs, doc_id, text), "signatures")
    usable = signed.where("n_shingles > 0 AND doc_id IS NOT NULL")
    first = usable.groupBy("d1", "d2").agg(F.min(F.struct(F.col("doc_id").alias("id"), "n_shingles", "bands")).alias("first"))
    lead = staged(first.select("first.*", "d1", "d2"), "classes")
    classes = lead.select("id", "d1", "d2")
    member = usable.select("doc_id", "d1", "d2").distinct().join(classes, ["d1", "d2"])
    same = member.where("doc_id != id").select(F.col("id").alias("a"), F.col("doc_id").alias("b"))
    edges = settled(docs.sparkSession, "spanning-links", lambda: links(docs, lead, doc_id, text, percent))
    # Copies hang on their representative; the graph of representatives is small beside them.
    digest = F.struct("d1", "d2")
    repeated = usable.groupBy("doc_id").agg(F.min(digest).alias("one"), F.max(digest).alias("other")).where("one != other")
    if repeated.isEmpty():
        found = settled(docs.sparkSession, "components", lambda: components(edges))
        labels = (member.join(found, F.col("id") == F.col("node"), "left")
                  .select("doc_id", F.coalesce("component", "id").alias("component_id")))
    else:
        found = settled(docs.sparkSession, "components", lambda: components(edges.union(same)))
        labels = found.select(F.col("node").alias("doc_id"), F.col("component").alias("component_id"))
    alone = F.coalesce("component_id", "doc_id")
    return (signed.select("doc_id", "n_shingles").join(labels, "doc_id", "left")
            .select("doc_id", "n_shingles", alone.alias("component_id"), F.coalesce(F.col("doc_id") == alone, F.lit(True)).alias("kept")))


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """`docs` without the near copies of a row with a smaller id; rows that share a kept id all stay."""
    gone = unused(docs, "_gone")
    found = near_duplicates(docs, doc_id, text, percent).where("NOT kept").select(F.col("doc_id").alias(gone))
    return docs.join(found, docs[doc_id] == F.col(gone), "left_anti")


def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents"))
