"""Language identification by rank-order profiles.

A profile lists the most frequent letter n-grams (1 to 3 letters, word ends marked) in order of frequency.
A text is compared with each language's profile by the out-of-place distance: the sum over the text's
own n-grams of how far their ranks differ, a fixed penalty where the profile lacks the n-gram.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from fleetframe.llm.common import in_fold, map_arrow, per_text, read, text_blocks

PROFILE = 400
TRAINING_ROWS = 40_000
SEGMENT = 1_000_000
UNDETERMINED = "und"
_SHIFT = 21


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """For each code point its lower-case letter, 0 if it is no letter."""
    table = np.zeros(0x110000, dtype=np.int64)
    for code in range(0x110000):
        char = chr(code)
        if unicodedata.category(char)[0] == "L":
            lower = char.lower()
            table[code] = ord(lower) if len(lower) == 1 else code
    return table


def letters_of(text: str) -> np.ndarray:
    """The text's letters, each run of other characters as one 0, with a 0 at both ends."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    codes = np.concatenate([[0], _letters()[points], [0]])
    return codes[(codes != 0) | (np.concatenate([[1], codes[:-1]]) != 0)]


def _grams(codes: np.ndarray) -> np.ndarray:
    """Keys of all 1-, 2- and 3-grams with a letter and without a word end inside."""
    one, two, three = codes[codes != 0], codes[:-1] + (codes[1:] << _SHIFT), codes[:-2] + (codes[1:-1] << _SHIFT)
    return np.concatenate([one, two, (three + (codes[2:] << 2 * _SHIFT))[codes[1:-1] != 0]])


def gram_counts(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams in order of their keys, and how often each occurs."""
    if len(codes) <= SEGMENT:
        return np.unique(_grams(codes), return_counts=True) if len(codes) > 2 else (codes[:0], codes[:0])
    ends = np.flatnonzero(codes == 0)
    keys, counts, start = codes[:0], codes[:0], 0
    while start < len(codes) - 1:
        last = ends[np.searchsorted(ends, start + SEGMENT, side="right") - 1]
        stop = last if last > start else ends[np.searchsorted(ends, start, side="right")]
        own, n = np.unique(_grams(codes[start:stop + 1]), return_counts=True)
        keys, at = np.unique(np.concatenate([keys, own]), return_inverse=True)
        counts = np.bincount(at, weights=np.concatenate([counts, n])).astype(np.int64)
        start = stop
    return keys, counts


def most_frequent(keys: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """Keys by falling count, equal counts by key."""
    return keys[np.argsort(-counts, kind="stable")[:size]]


def learn_profiles(docs: DataFrame, text: str = "text", lang: str = "lang", size: int = PROFILE) -> dict[str, list[int]]:
    """The n-grams of each language, most frequent first: `size` per language reach the driver.

    Rows without language or text do not take part.
    """
    source = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(lang).cast("string").alias("_lang"), F.col(text).cast("string").alias("_text"))
    schema = T.StructType().add("lang", "string").add("gram", "long").add("n", "long")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, texts in text_blocks(batches, "_text"):
            by: dict[str, list[np.ndarray]] = {}
            for name, own in zip(block.column("_lang").to_pylist(), texts, strict=True):
                by.setdefault(name, []).append(letters_of(own))
            for name, parts in by.items():
                keys, counts = gram_counts(np.concatenate(parts))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(keys), pa.string()), pa.array(keys, pa.int64()), pa.array(counts, pa.int64())],
                    names=["lang", "gram", "n"])

    counted = map_arrow(source, count, schema).groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    rows = counted.withColumn("place", place).where(F.col("place") <= size).orderBy("lang", "place").collect()
    profiles: dict[str, list[int]] = {}
    for row in rows:
        profiles.setdefault(row["lang"], []).append(row["gram"])
    return profiles


class Profiles:
    """Profiles in the form that makes comparing fast."""

    def __init__(self, profiles: dict[str, list[int]], size: int):
        self.size = size
        self.names = sorted(profiles)
        grams = sorted({g for p in profiles.values() for g in p})
        self.grams = np.array([*grams, np.iinfo(np.int64).max], dtype=np.int64)
        self.ranks = np.full((len(self.names), len(self.grams)), -1, dtype=np.int64)
        for i, name in enumerate(self.names):
            self.ranks[i, self.grams.searchsorted(profiles[name])] = np.arange(len(profiles[name]))

    def nearest(self, text: str) -> tuple[str, float]:
        codes = letters_of(text)
        if not self.names or not codes.any():
            return UNDETERMINED, 0.0
        own = most_frequent(*gram_counts(codes), self.size)
        at = self.grams.searchsorted(own)
        ranks = np.where(self.grams[at] == own, self.ranks[:, at], -1)
        away = np.where(ranks >= 0, np.abs(ranks - np.arange(len(own))), self.size).sum(axis=1)
        best = int(away.argmin())
        return self.names[best], 1.0 - float(away[best]) / (self.size * len(own))


def identify(docs: DataFrame, profiles: dict[str, list[int]], keep: list[str], text: str = "text",
             size: int = PROFILE) -> DataFrame:
    """Per row: lang_pred and score, 1 minus the distance's share of the greatest possible one.

    Equal distances: the first language by name. Null texts, texts without a letter, and all texts if no
    profile was learned: `und` with score 0. Repeated rows stay repeated.
    """
    def worker(texts: list[str | None]) -> dict[str, list]:
        known = Profiles(profiles, size)
        found = [known.nearest(t or "") for t in texts]
        return {"lang_pred": [f[0] for f in found], "score": [f[1] for f in found]}

    return per_text(docs, keep, text, "lang_pred string, score double", worker)


def training_rows(docs: DataFrame, doc_id: str, lang: str, bound: int = TRAINING_ROWS) -> DataFrame:
    """About `bound` rows with a language: the languages take turns, each by the smallest id hashes.

    So a rare language is learned at every size. Only ids and languages are sorted, first in 64 parts.
    """
    def first(rows: DataFrame, *part: str) -> DataFrame:
        turn = F.row_number().over(Window.partitionBy(*part).orderBy("_hash"))
        return rows.withColumn("_turn", turn).where(F.col("_turn") <= bound)

    ids = (docs.where(F.col(lang).isNotNull())
           .select(F.col(lang).cast("string").alias("_lang"), F.xxhash64(doc_id).alias("_hash"))
           .withColumn("_part", F.pmod(F.xxhash64("_hash"), F.lit(64))))
    chosen = (first(first(ids, "_lang", "_part"), "_lang").orderBy("_turn", "_hash", "_lang").limit(bound)
              .select("_hash").distinct())
    return docs.where(F.col(lang).isNotNull()).join(F.broadcast(chosen), F.xxhash64(doc_id) == F.col("_hash"), "left_semi")


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = in_fold("doc_id", 4, 2)
    profiles = learn_profiles(training_rows(docs.where(~held_out), "doc_id", "lang"))
    found = identify(docs.withColumn("held_out", held_out), profiles, ["doc_id", "held_out"])
    return found.select("doc_id", "held_out", "lang_pred", "score")
