"""Toxicity by a learned lexicon, misspellings and context.

Learning (labelled rows, a bounded sample): words and word stems that occur in toxic texts more often than
chance allows enter the lexicon with their log-likelihood ratio. Occurrences with the same neighbours count
once, so the ordinary words of a copied toxic text stay out.

Scoring (all rows, whole texts): each word runs through the Levenshtein automaton of the lexicon's trie,
as a set of (node, edits) states that dies as soon as no entry is near. Only entries without ordinary words
around them are matched with an edit, stems too; entries of three letters never are. A window around each hit tells a quoted term from abuse. The
evidence of a text and its density become a probability by a logistic fit on the sample.
"""

import math
import re
import zlib
from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetframe.llm.common import in_fold, map_arrow, per_text, read, ship, small_batches, staged, text_blocks

TRAINING_ROWS = 40_000
MAX_CANDIDATES = 4_000
MIN_EVIDENCE = 12.0
MIN_PRECISION = 0.75
STEM_LENGTHS = range(4, 9)
STEM_WORDS = 3
FUZZY_LENGTH = 5
FREE_LENGTH = 4
WINDOW = 80
MEMO = 100_000
#: How much of an entry's evidence a hit carries.
CARRIED = {"exact": 1.0, "near": 0.7, "exact quoted": 0.1, "near quoted": 0.05}
_WORD = re.compile(r"[^\W_]+")
_OPENING, _CLOSING = "\"“„«‹‘", "\"”“»›’"


@dataclass
class Lexicon:
    """Evidence of terms and of stems, entries that allow an edit, and the coefficients of the fit.

    `fuzzy`: one edit after the first letter, in words of FUZZY_LENGTH letters or more; `free`: one edit
    anywhere, in words of any length. A stem is written there with a `*` at its end.
    """

    terms: dict[str, float] = field(default_factory=dict)
    stems: dict[str, float] = field(default_factory=dict)
    fuzzy: set[str] = field(default_factory=set)
    fit: tuple[float, float, float] = (-4.0, 1.0, 0.0)
    free: set[str] = field(default_factory=set)


class Automaton:
    """Levenshtein automaton over a trie. A node is a dict of children; `None` marks a term, `""` a stem."""

    def __init__(self, lexicon: Lexicon):
        self.root: dict = {}
        for entry, mark in [*((t, None) for t in lexicon.terms), *((s, "") for s in lexicon.stems)]:
            node = self.root
            for char in entry:
                node = node.setdefault(char, {})
            node[mark] = entry
        self.lexicon = lexicon
        self.memo: dict[str, tuple[str, str] | None] = {}

    def match(self, word: str) -> tuple[str, str] | None:
        """(`exact` or `near`, the entry) for a lower-case word, None if no entry is that near."""
        if word in self.memo:
            return self.memo[word]
        if len(self.memo) >= MEMO:
            self.memo.clear()
        exact, near = self.entries(word)
        found = ("exact", exact) if exact else ("near", min(near).removesuffix("*")) if near else None
        self.memo[word] = found
        return found

    def _allowed(self, key: str, word: str) -> bool:
        if key in self.lexicon.free:
            return True
        return key in self.lexicon.fuzzy and key[0] == word[0] and len(word) >= FUZZY_LENGTH

    def entries(self, word: str) -> tuple[str | None, set[str]]:
        """The exact entry, and else all that allow the edit to this word; a stem ends in `*`."""
        edits = 1 if self.lexicon.free or len(word) >= FUZZY_LENGTH else 0
        near: set[str] = set()
        # Each state is a node and the edits spent on the way to it.
        states = [(self.root, 0)]
        if edits:
            states += [(child, 1) for c, child in self.root.items() if c]
        for char in word:
            following = []
            for node, spent in states:
                if "" in node:
                    if not spent:
                        return node[""], set()
                    near.add(node[""] + "*")
                if child := node.get(char):
                    following.append((child, spent))
                    if spent < edits:
                        following += [(below, 1) for c, below in child.items() if c]
                if spent < edits:
                    following.append((node, 1))
                    following += [(child, 1) for c, child in node.items() if c and c != char]
            states = following
            if not states:
                break
        for node, spent in states:
            for mark in (None, ""):
                if mark in node:
                    if not spent:
                        return node[mark], set()
                    near.add(node[mark] + ("" if mark is None else "*"))
        return None, {key for key in near if self._allowed(key, word)}


def quoted(text: str, start: int, end: int) -> bool:
    """Whether the window has an odd number of opening marks before the term and a closing one after it."""
    before, after = text[max(0, start - WINDOW):start], text[end:end + WINDOW]
    line = before.rpartition("\n")[2]
    if line.count('"') % 2 and '"' in after:
        return True
    return any(line.rfind(o) > line.rfind(c) and c in after
               for o, c in zip(_OPENING[1:], _CLOSING[1:], strict=True))


def evidence(text: str, automaton: Automaton) -> tuple[float, float, int]:
    """Evidence of the distinct words hit, its density in the text, and the number of those words.

    A word that stands once outside quotation counts as unquoted.
    """
    words = _WORD.findall(text.lower())
    found = {w: m for w in set(words) if (m := automaton.match(w))}
    if not found:
        return 0.0, 0.0, 0
    plain: set[str] = set()
    lowered = text.lower()
    for place in _WORD.finditer(lowered):
        if place[0] in found and place[0] not in plain and not quoted(lowered, *place.span()):
            plain.add(place[0])
    lexicon, total = automaton.lexicon, 0.0
    for word, (sort, entry) in sorted(found.items()):
        carried = CARRIED[sort if word in plain else f"{sort} quoted"]
        total += carried * lexicon.terms.get(entry, lexicon.stems.get(entry, 0.0))
    return total, total / math.sqrt(len(words)), len(found)


def score_of(total: float, density: float, fit: tuple[float, float, float]) -> float:
    if not total:
        return 0.0
    return 1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, fit[0] + fit[1] * total + fit[2] * density))))


def _training(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, label: str, bound: int) -> DataFrame:
    known = (labels.where(F.col(doc_id).isNotNull() & F.col(label).isNotNull())
             .groupBy(F.col(doc_id).alias("_id")).agg(F.max(F.col(label).cast("int")).alias("_toxic"))
             .orderBy(F.xxhash64("_id"), "_id").limit(bound))
    rows = docs.select(F.col(doc_id).alias("_id"), F.col(text).cast("string").alias("_text"))
    return rows.join(F.broadcast(known), "_id").where(F.col("_text").isNotNull()).select("_toxic", "_text")


def _rows(df: DataFrame, schema: str, made) -> DataFrame:
    """mapInArrow over blocks of (`_toxic`, `_text`); `made` yields tuples of the schema."""
    kinds = {"string": pa.string(), "long": pa.int64(), "double": pa.float64()}
    fields = [(name, kinds[kind]) for name, kind in (f.split() for f in schema.split(", "))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, texts in text_blocks(batches, "_text"):
            rows = list(made(zip(block.column("_toxic").to_pylist(), texts, strict=True)))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, (_, kind) in enumerate(fields)],
                                             names=[name for name, _ in fields])

    small_batches(df.sparkSession)
    return map_arrow(df, run, schema)


def _word_counts(pairs: Iterable[tuple[int, str]]) -> Iterator[tuple[str, int, int]]:
    counts: dict[str, list[int]] = defaultdict(lambda: [0, 0])
    for toxic, text in pairs:
        for word in set(_WORD.findall(text.lower())):
            counts[word][0 if toxic else 1] += 1
    return ((word, t, c) for word, (t, c) in counts.items())


def _surprise(base: float) -> Column:
    """How far the share t / (t + c) lies above the share of toxic texts, in nats; 0 if it does not."""
    t, c = F.col("t"), F.col("c")
    share = t / (t + c)
    clean = F.when(c > 0, c * F.log((1 - share) / (1 - base))).otherwise(0.0)
    return F.when(share > max(base, MIN_PRECISION), t * F.log(share / base) + clean).otherwise(0.0)


def _fit(rows: list[tuple[float, float, int]]) -> tuple[float, float, float]:
    """Logistic regression on evidence and density by Newton steps, with a small ridge."""
    x = np.array([(1.0, total, density) for total, density, _ in rows])
    y = np.array([float(toxic) for *_, toxic in rows])
    w, ridge = np.zeros(3), np.diag([1e-3, 1e-2, 1e-2])
    for _ in range(30):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (y - p) - ridge @ w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return float(w[0]), float(w[1]), float(w[2])


def learn(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic",
          bound: int = TRAINING_ROWS) -> Lexicon:
    """The lexicon of the at most `bound` labelled texts whose ids have the smallest hashes.

    What reaches the driver is bounded by that sample: two numbers per text of the sample, and the lexicon,
    the at most MAX_CANDIDATES words and stems with the most evidence after copied occurrences are merged. Ids without text or label do not take part; of several labels of
    an id the greatest counts. Without toxic or without other rows the lexicon is empty.
    """
    rows = staged(_training(docs, labels, doc_id, text, label, bound), "toxicity-rows")
    sizes = {r["_toxic"]: r["count"] for r in rows.groupBy("_toxic").count().collect()}
    toxic, other = sum(n for y, n in sizes.items() if y), sizes.get(0, 0)
    if not toxic or not other:
        return Lexicon()
    base = toxic / (toxic + other)
    counted = _rows(rows, "word string, t long, c long", _word_counts)
    words = staged(counted.groupBy("word").agg(F.sum("t").alias("t"), F.sum("c").alias("c")), "toxicity-words")

    def contexts(pairs: Iterable[tuple[int, str]]) -> Iterator[tuple[str, int]]:
        seen = set()
        for is_toxic, own in pairs:
            if is_toxic:
                tokens = ["", *_WORD.findall(own.lower()), ""]
                seen.update((word, zlib.crc32(f"{before} {word} {after}".encode()))
                            for before, word, after in zip(tokens, tokens[1:-1], tokens[2:]))
        return iter(seen)

    # A word counts by its distinct contexts, in no more texts than hold it: copies add nothing.
    distinct = _rows(rows, "own string, context long", contexts).distinct().groupBy("own").agg(F.count("context").alias("d"))
    words = staged(words.join(distinct, F.col("word") == F.col("own"), "left")
                   .select("word", "t", "c", F.least("t", F.coalesce("d", F.lit(0))).alias("e")), "toxicity-contexts")
    stem = F.explode(F.array(*[F.when(F.length("word") > n, F.substring("word", 1, n)) for n in STEM_LENGTHS]))
    by_stem = (words.select(stem.alias("word"), "c", "e").where(F.col("word").isNotNull()).groupBy("word")
               .agg(F.sum("c").alias("c"), F.sum("e").alias("e"), F.count_if(F.col("e") > F.col("c")).alias("words"))
               .where(F.col("words") >= STEM_WORDS).select(F.concat("word", F.lit("*")).alias("word"), "c", "e"))
    possible = (words.where(F.length("word") >= 3).select("word", "c", "e").unionByName(by_stem).where("e > 0")
                .select("word", "c", F.col("e").alias("t")).withColumn("surprise", _surprise(base))
                .where(F.col("surprise") >= MIN_EVIDENCE).orderBy(F.desc("surprise"), "word").limit(MAX_CANDIDATES))
    found = {r["word"]: (r["t"], r["c"]) for r in possible.collect()}
    weight = {w: math.log((t + 0.5) / toxic / ((c + 0.5) / other)) for w, (t, c) in found.items()}
    # The best stem of each family. Terms that a stem covers stay: an edit of theirs may lie before its end.
    stems: dict[str, float] = {}
    for entry in sorted((w for w in weight if w[-1] == "*"), key=lambda w: (-found[w][0], -weight[w], -len(w), w)):
        if not any(entry[:-1].startswith(s) or s.startswith(entry[:-1]) for s in stems):
            stems[entry[:-1]] = weight[entry]
    terms = {w: v for w, v in weight.items() if w[-1] != "*"}
    keys = [*terms, *(f"{s}*" for s in stems)]
    lexicon = Lexicon(terms, stems, {k for k in keys if len(k.rstrip("*")) >= FUZZY_LENGTH},
                      free={k for k in keys if len(k.rstrip("*")) >= FREE_LENGTH})

    def crowded(pairs: Iterable[tuple[int, str]]) -> Iterator[tuple[str, int]]:
        """Entries with an ordinary word an edit away; 1 if the first letter stands in a word long enough."""
        automaton = Automaton(lexicon)
        return iter({(key, int(key[0] == word[0] and len(word) >= FUZZY_LENGTH))
                     for _, word in pairs for key in automaton.entries(word)[1]})

    ordinary = words.where("c > t").select(F.lit(0).alias("_toxic"), F.col("word").alias("_text"))
    near = _rows(ordinary, "word string, stands long", crowded).distinct().collect()
    lexicon.free -= {r["word"] for r in near}
    lexicon.fuzzy -= {r["word"] for r in near if r["stands"]}

    def measured(pairs: Iterable[tuple[int, str]]) -> Iterator[tuple[float, float, int]]:
        automaton = Automaton(lexicon)
        return ((*evidence(own, automaton)[:2], int(is_toxic > 0)) for is_toxic, own in pairs)

    lexicon.fit = _fit([(r["total"], r["density"], r["toxic"]) for r in
                        _rows(rows, "total double, density double, toxic long", measured).collect()])
    return lexicon


def toxicity(docs: DataFrame, lexicon: Lexicon, keep: list[str], text: str = "text") -> DataFrame:
    """Per row: score (0 to 1), predicted (1 from 0.5 on) and n_terms, the number of distinct words hit.

    Null and empty texts score 0. Repeated rows stay repeated.
    """
    def worker(texts: list[str | None]) -> dict[str, list]:
        automaton = Automaton(lexicon)
        found = [evidence(t, automaton) if t else (0.0, 0.0, 0) for t in texts]
        scores = [score_of(total, density, lexicon.fit) for total, density, _ in found]
        return {"score": scores, "predicted": [int(s >= 0.5) for s in scores], "n_terms": [n for *_, n in found]}

    return per_text(docs, keep, text, "score double, predicted int, n_terms long", worker)


def drop_toxic(docs: DataFrame, lexicon: Lexicon, text: str = "text") -> DataFrame:
    """`docs` without the rows whose text scores 0.5 or more; null and empty texts stay, columns unchanged."""
    ship(docs.sparkSession)
    small_batches(docs.sparkSession)

    @F.pandas_udf("boolean")
    def rejected(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        automaton = Automaton(lexicon)  # one for all batches of a task, with the words that it has met
        for texts in batches:
            yield texts.map(lambda t: bool(t) and score_of(*evidence(t, automaton)[:2], lexicon.fit) >= 0.5)

    return docs.where(~rejected(F.col(text).cast("string")))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents").select("doc_id", "text"), read(spark, sf_dir, "labels")
    held_out = in_fold("doc_id", 5, 0)
    lexicon = learn(docs, labels.select("doc_id", "toxic").where(~held_out))
    scored = toxicity(docs.withColumn("held_out", held_out), lexicon, ["doc_id", "held_out"])
    return scored.select("doc_id", "held_out", "score", "predicted", "n_terms")
