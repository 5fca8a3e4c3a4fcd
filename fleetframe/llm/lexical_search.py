"""Ranked lexical search, term at a time with limited accumulators.

The documents are indexed once for the terms of the queries: per document the number of its terms, and the terms that
some query asks for with their occurrences. Every task turns blocks of that index into inverted lists and serves the
queries over them. A query's terms are taken rarest first. A document gets an accumulator when it is first met; once what
the remaining terms can add at most stays below the k-th best partial score, no new accumulator is made, and the lists
that follow only update those there are, exactly. A task carries the k best rows of each query from block to block, so that
the bound to reach rises. The rows of all tasks, k per query and task at most, meet in two steps.

Scores are sums of 64-bit integers, so they do not depend on the order of the terms or on how the documents are dealt.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from fleetframe.llm.common import BROADCAST_BYTES, map_arrow, per_text, read, row_key, ship, staged
from fleetframe.llm.decontaminate import LOWER, UPPER, words_of

TOP = 20
#: Score of a term: w * (SCALE * tf div (1000 * tf + SLOPE * m)), m = 100 - LENGTH + LENGTH * n * N div L.
SCALE, SLOPE, LENGTH = 1_000_000_000, 12, 25
#: Postings that a task turns into inverted lists at a time.
BLOCK_POSTINGS = 2_000_000
_LETTERS = bytes(range(0x30, 0x3A)) + bytes(range(0x41, 0x5B)) + bytes(range(0x61, 0x7B)) + bytes(range(0x80, 0x100))
#: A-Z to a-z, everything that is no part of a term to a blank.
_TABLE = bytes(b + 32 if 0x41 <= b < 0x5B else b if b in _LETTERS else 0x20 for b in range(256))


def terms_of(text: str | None) -> list[bytes]:
    """The terms of a text, as UTF-8, A-Z lowered; null has none."""
    return (text or "").encode().translate(_TABLE).split()


def weight(docs: int, holding: int) -> int:
    """The weight of a term that `holding` of `docs` documents hold."""
    return math.floor(1000 * math.log((2 * docs + 2) / (2 * holding + 1)))


@dataclass(frozen=True)
class Query:
    """An item's terms, rarest first: numbers in the index, weights times repeats."""

    number: int
    terms: tuple[int, ...]
    weights: tuple[int, ...]


def query_terms(items: DataFrame, item_id: str, text: str) -> DataFrame:
    """(item, item_id, term, times): the terms of each item. Equal rows are one item; without terms there is no row."""
    item = items.select(row_key(item_id, text).alias("item"), F.col(item_id).alias("item_id"),
                        words_of(F.col(text).cast("string")).alias("words")).dropDuplicates(["item"])
    spread = item.select("item", "item_id", F.explode("words").alias("term"))
    return spread.groupBy("item", "item_id", "term").agg(F.count(F.lit(1)).alias("times"))


def index(docs: DataFrame, vocabulary: list[str], doc_id: str, text: str) -> DataFrame:
    """(doc_id, n, terms, times), one row per row of `docs`: n counts all terms, `terms` are those of the vocabulary.

    A term is its place in `vocabulary`; `terms` ascend.
    """
    sent = docs.sparkSession.sparkContext.broadcast({term.encode(): i for i, term in enumerate(vocabulary)})

    def worker(texts: list[str | None]) -> dict[str, list]:
        known = sent.value
        sizes, terms, times = [], [], []
        for value in texts:
            found = terms_of(value)
            counted = Counter(found)
            own = sorted((known[t], counted[t]) for t in known.keys() & counted.keys()) if counted else []
            sizes.append(len(found))
            terms.append([t for t, _ in own])
            times.append([n for _, n in own])
        return {"n": sizes, "terms": terms, "times": times}

    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return per_text(source, ["doc_id"], "text", "n long, terms array<int>, times array<int>", worker)


class Best:
    """The k best rows of one query: highest score first, then the smallest id, null ids last."""

    def __init__(self, k: int):
        self.k = k
        self.rows: list[tuple[int, bool, object]] = []

    @property
    def least(self) -> int:
        """What a new document must reach at least to be among the k best; 1 while there are fewer."""
        return -self.rows[-1][0] if len(self.rows) == self.k else 1

    def add(self, scores: Iterable[int], ids: Iterable[object]) -> None:
        rows = self.rows + [(-score, doc is None, doc) for score, doc in zip(scores, ids, strict=True)]
        rows.sort(key=lambda row: row if row[2] is not None else (*row[:2], 0))
        self.rows = rows[:self.k]


class Block:
    """Inverted lists over the documents of a block."""

    def __init__(self, sizes: np.ndarray, offsets: np.ndarray, terms: np.ndarray, times: np.ndarray, mean: tuple[int, int]):
        docs, length = mean
        m = 100 - LENGTH + (LENGTH * sizes * docs) // max(length, 1)
        doc = np.repeat(np.arange(len(sizes), dtype=np.int32), np.diff(offsets))
        order = terms.argsort(kind="stable")
        self.size = len(sizes)
        self.terms, starts = np.unique(terms[order], return_index=True)
        self.starts = np.append(starts, len(order))
        self.docs = doc[order]
        tf = times[order].astype(np.int64)
        self.impacts = (SCALE * tf) // (1000 * tf + SLOPE * m[self.docs])
        self.greatest = np.maximum.reduceat(self.impacts, starts) if len(order) else starts
        self.place = {int(t): i for i, t in enumerate(self.terms)}

    def search(self, query: Query, k: int, least: int, stats: dict[str, int] | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(documents, scores) of those that may be among the k best: all that reach `least` and are not surely worse."""
        lists = [(self.place[t], w) for t, w in zip(query.terms, query.weights, strict=True) if t in self.place and w]
        rest = np.append(np.cumsum([int(self.greatest[i]) * w for i, w in lists][::-1])[::-1], 0)
        scores = np.zeros(self.size, dtype=np.int64)
        open_, made = True, 0
        for at, (i, w) in enumerate(lists):
            docs = self.docs[self.starts[i]:self.starts[i + 1]]
            added = w * self.impacts[self.starts[i]:self.starts[i + 1]]
            if open_:
                if made >= k <= self.size:
                    least = max(least, int(np.partition(scores, self.size - k)[self.size - k]))
                # A new document needs all of what remains to reach the k-th best.
                open_ = rest[at] >= least
            if not open_:
                old = scores[docs] > 0
                docs, added = docs[old], added[old]
            scores[docs] += added
            made += len(docs) if open_ else 0
            if stats is not None:
                stats["updated"] = stats.get("updated", 0) + len(docs)
                stats["skipped"] = stats.get("skipped", 0) + int(self.starts[i + 1] - self.starts[i]) - len(docs)
        found = np.flatnonzero(scores >= max(least, 1))
        if len(found) > k:
            # Ties with the k-th stay, the ids decide among them.
            kth = np.partition(scores[found], len(found) - k)[len(found) - k]
            found = found[scores[found] >= kth]
        return found, scores[found]


def best_rows(ids: pa.Array, found: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Of equal scores at the end the smallest ids, so that a large group of ties stays small."""
    if len(found) <= k:
        return np.arange(len(found))
    table = pa.table({"score": scores, "id": ids.take(pa.array(found))})
    return pc.sort_indices(table, [("score", "descending"), ("id", "ascending")]).to_numpy()[:k]


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of the index, joined up to about BLOCK_POSTINGS postings."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += len(batch.column("terms").flatten())
        if size >= BLOCK_POSTINGS:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, size = [], 0
    joined = pa.Table.from_batches(held).combine_chunks().to_batches() if held else []
    yield from joined[:1]


def search_index(indexed: DataFrame, queries: list[Query], mean: tuple[int, int], k: int) -> DataFrame:
    """(query, score, doc_id): each task's k best documents of each query."""
    spark, kind = indexed.sparkSession, indexed.schema["doc_id"].dataType
    sent = spark.sparkContext.broadcast(queries)
    out = T.StructType([T.StructField("query", T.IntegerType()), T.StructField("score", T.LongType()), T.StructField("doc_id", kind)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        target = to_arrow_schema(out)
        best = {q.number: Best(k) for q in sent.value}
        for batch in _blocks(batches):
            ids, lists = batch.column("doc_id"), batch.column("terms")
            offsets = lists.offsets.to_numpy() - lists.offsets[0].as_py()
            block = Block(batch.column("n").to_numpy(), offsets, lists.flatten().to_numpy(),
                          batch.column("times").flatten().to_numpy(), mean)
            for query in sent.value:
                own = best[query.number]
                found, scores = block.search(query, k, own.least)
                chosen = best_rows(ids, found, scores, k)
                if len(chosen):
                    own.add(scores[chosen].tolist(), ids.take(pa.array(found[chosen])).to_pylist())
        rows = [(number, -score, doc) for number, own in best.items() for score, _, doc in own.rows]
        if rows:
            columns = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, target, strict=True)], schema=target)

    return map_arrow(indexed, run, out)


def _query_blocks(terms: DataFrame, bound: int) -> int:
    """Into how many blocks the queries are dealt so that one of them stays within the bound."""
    size = terms.agg(F.sum(F.octet_length("term") + 64)).first()[0] or 0
    return -(-size // bound)


def search(docs: DataFrame, items: DataFrame, k: int = TOP, doc_id: str = "doc_id", text: str = "text",
           item_id: str = "item_id", item_text: str = "text", bound: int = BROADCAST_BYTES) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents with a score above 0 of each item.

    Every row of `docs` is a document; repeated ones are ranked one by one. Equal scores rank by ascending doc_id, null
    ids last. Equal rows of `items` are one item. Items and documents without terms have no rows here, null texts have no
    terms. The terms of the items are sent to the tasks: `bound` is the most bytes of them at a time, more items are
    answered block by block, each block over all documents.
    """
    spark = docs.sparkSession
    ship(spark)
    terms = staged(query_terms(items, item_id, item_text), "query-terms")
    blocks = _query_blocks(terms, bound)
    schema = T.StructType([T.StructField("item_id", items.schema[item_id].dataType), T.StructField("rank", T.IntegerType()),
                           T.StructField("doc_id", docs.schema[doc_id].dataType), T.StructField("score", T.LongType())])
    made = [_search_block(docs, terms.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == b), k, doc_id, text) for b in range(blocks)]
    return reduce(DataFrame.union, made) if made else spark.createDataFrame([], schema)


def _search_block(docs: DataFrame, terms: DataFrame, k: int, doc_id: str, text: str) -> DataFrame:
    # Bounded by `bound` of `search`.
    asked = terms.select("item", "term", "times").collect()
    vocabulary = sorted({row.term for row in asked})
    number = {term: i for i, term in enumerate(vocabulary)}
    indexed = staged(index(docs, vocabulary, doc_id, text), "search-index")
    n_docs, length = indexed.agg(F.count(F.when(F.col("n") > 0, 1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    held = indexed.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    df = {row.term: row.df for row in held.collect()}
    items = sorted({row.item for row in asked})
    place = {item: i for i, item in enumerate(items)}
    wanted: dict[int, list[tuple[int, int, int]]] = {i: [] for i in range(len(items))}
    for row in asked:
        term = number[row.term]
        if term in df:
            wanted[place[row.item]].append((df[term], term, row.times))
    queries = [Query(i, tuple(t for _, t, _ in own), tuple(times * weight(n_docs, d) for d, _, times in own))
               for i, own in ((i, sorted(own)) for i, own in wanted.items())]
    found = search_index(indexed, queries, (n_docs, length), k)
    order = (F.desc("score"), F.asc_nulls_last("doc_id"))
    # Two steps: what the tasks found for an item does not meet in one place.
    salted = found.withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(64)))
    first = (salted.withColumn("_place", F.row_number().over(Window.partitionBy("query", "_salt").orderBy(*order)))
             .where(F.col("_place") <= k).drop("_place", "_salt"))
    ranked = (first.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(*order)))
              .where(F.col("rank") <= k))
    names = docs.sparkSession.createDataFrame([(place[i], i) for i in items], "query int, item string")
    ids = terms.select("item", "item_id").distinct()
    return (ranked.join(F.broadcast(names), "query").join(F.broadcast(ids), "item")
            .select("item_id", "rank", "doc_id", "score"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


_TERMS = "regexp_extract_all(translate({}, '" + UPPER + "', '" + LOWER + "'), '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+')"

OP12_SQL = f"""
WITH docs AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, {_TERMS.format('text')} AS terms FROM documents),
counts AS (SELECT count(*) FILTER (len(terms) > 0) AS n_docs, sum(len(terms)) AS length FROM docs),
postings AS (SELECT rid, doc_id, len(terms) AS n, unnest(terms) AS term FROM docs),
tf AS (SELECT rid, doc_id, n, term, count(*) AS tf FROM postings GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
weights AS (SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1))) AS BIGINT) AS w FROM df, counts),
items AS (SELECT item_id, text FROM benchmark GROUP BY ALL),
asked AS (SELECT item_id, text, unnest({_TERMS.format('text')}) AS term FROM items),
scored AS (SELECT a.item_id, a.text, t.rid, t.doc_id, CAST(sum(w * (({SCALE} * tf) //
               (1000 * tf + {SLOPE} * ({100 - LENGTH} + ({LENGTH} * n * n_docs) // CAST(length AS BIGINT))))) AS BIGINT) AS score
           FROM asked a JOIN tf t USING (term) JOIN weights USING (term), counts GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id, rid) AS place
           FROM scored WHERE score > 0)
SELECT item_id, CAST(place AS INTEGER) AS rank, doc_id, score FROM ranked WHERE place <= {TOP}
"""
