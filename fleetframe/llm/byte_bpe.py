"""Byte-level BPE by merge replay over the distinct words of a block of the corpus.

A block's texts are cut into units (a word with the blank before it), the units into the pieces of the
split pattern. Each piece that is new to the worker takes part in one replay: an inverted index maps
the merge that a pair of neighbouring tokens allows to the positions of that pair, and the merges are
applied in rank order, each at all its positions, touching only the neighbours of what was merged.
Words do not influence each other, so results do not depend on where blocks begin.
"""

import base64
import hashlib
import re
from array import array
from heapq import heappop, heappush

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetframe.llm.common import per_text, read, ship, worker_state

#: About the bytes of Python objects that a worker keeps; longer units than LONG characters are not kept.
CACHE_BYTES, LONG = 64_000_000, 64
_CUT = re.compile(r"(?<=\S) (?=\S)")
_RUN = re.compile(r"\s | \s")


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def units(text: str) -> list[str]:
    """The text cut before each blank that stands alone between two other characters.

    No match of the split pattern crosses such a cut: a match has a blank only in front or among
    white space.
    """
    odd = _RUN.search(text) or text[:1] == " " or text[-1:] == " "
    first, *rest = _CUT.split(text) if odd else text.split(" ")
    return [first, *[" " + p for p in rest]]


class Replay:
    """Merge replay with the tokens of one rank file."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.pattern = regex.compile(pattern)
        self.single = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int32)
        self.width = max(self.tokens) + 1
        self.cache: dict[str, bytes] = {}
        self.held = 0
        pairs, made = array("q", [np.iinfo(np.int64).max]), array("i", [-1])
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                left, right = ranks.get(token[:i]), ranks.get(token[i:])
                if left is not None and right is not None:
                    pairs.append(left * self.width + right)
                    made.append(rank)
        order = np.argsort(np.frombuffer(pairs, dtype=np.int64))
        self.pairs = np.frombuffer(pairs, dtype=np.int64)[order]
        self.made = np.frombuffer(made, dtype=np.int32)[order]

    def _merges(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the token that each pair makes, -1 where there is none."""
        wanted = left.astype(np.int64) * self.width + right
        at = self.pairs.searchsorted(wanted)
        return np.where(self.pairs[at] == wanted, self.made[at], -1)

    def replay(self, words: list[bytes]) -> list[bytes]:
        """Token ids of each word, as little-endian 32-bit integers."""
        sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        ends = sizes.cumsum()
        ids = self.single[np.frombuffer(b"".join(words), dtype=np.uint8)]
        after = np.arange(1, len(ids) + 1, dtype=np.int32)
        before = np.arange(-1, len(ids) - 1, dtype=np.int32)
        after[ends[sizes > 0] - 1] = -1
        before[(ends - sizes)[sizes > 0]] = -1

        index: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []

        def enter(places: np.ndarray, ranks: np.ndarray) -> None:
            order = ranks.argsort(kind="stable")
            places, ranks = places[order], ranks[order]
            cuts = [0, *(np.flatnonzero(ranks[1:] != ranks[:-1]) + 1).tolist(), len(ranks)]
            for start, end in zip(cuts, cuts[1:], strict=False):
                rank = int(ranks[start])
                if rank not in index:
                    index[rank] = []
                    heappush(heap, rank)
                index[rank].append(places[start:end])

        first = np.flatnonzero(after >= 0).astype(np.int32)
        ranks = self._merges(ids[first], ids[first + 1])
        if (ranks >= 0).any():
            enter(first[ranks >= 0], ranks[ranks >= 0])
        disordered: list[np.ndarray] = []
        while heap:
            rank = heappop(heap)
            found = index.pop(rank)
            places = found[0] if len(found) == 1 else np.unique(np.concatenate(found))
            places = places[(ids[places] >= 0) & (after[places] >= 0)]
            places = places[self._merges(ids[places], ids[after[places]]) == rank]
            if len(places) > 1 and (after[places[:-1]] == places[1:]).any():
                places = _leftmost(places, after)
            if not len(places):
                continue
            right = after[places]
            beyond = after[right]
            ids[places], ids[right], after[places] = rank, -1, beyond
            inner = beyond >= 0
            before[beyond[inner]] = places[inner]
            left = before[places]
            outer = left >= 0
            touched = np.concatenate([left[outer], places[inner]])
            if len(touched):
                ranks = self._merges(ids[touched], ids[after[touched]])
                usable = ranks >= 0
                if usable.any():
                    touched, ranks = touched[usable], ranks[usable]
                    if ranks.min() < rank:
                        disordered.append(touched[ranks < rank])
                    enter(touched, ranks)
        alive = ids >= 0
        stops = (4 * np.concatenate([[0], alive.cumsum()])[ends]).tolist()
        packed = ids[alive].astype("<u4").tobytes()
        out = [packed[a:b] for a, b in zip([0, *stops], stops, strict=False)]
        # Where a merge made room for one of lower rank, a word's other merges had to wait for it.
        for i in {int(i) for places in disordered for i in ends.searchsorted(places, side="right")}:
            out[i] = self._one_by_one(words[i])
        return out

    def _one_by_one(self, word: bytes) -> bytes:
        """Lowest rank first, leftmost first, one merge at a time."""
        parts = [word[i:i + 1] for i in range(len(word))]
        while True:
            ranked = [(r, i) for i in range(len(parts) - 1) if (r := self.ranks.get(parts[i] + parts[i + 1])) is not None]
            if not ranked:
                return np.array([self.ranks[p] for p in parts], dtype="<u4").tobytes()
            _, i = min(ranked)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]

    def _learn(self, new: set[str]) -> dict[str, bytes]:
        """The ids of new units, as little-endian 32-bit integers; the short ones go into the cache."""
        pieces = {unit: self.pattern.findall(unit) for unit in new}
        distinct = list({p for found in pieces.values() for p in found})
        packed = dict(zip(distinct, self.replay([p.encode() for p in distinct]), strict=True))
        made = {unit: b"".join([packed[p] for p in found]) for unit, found in pieces.items()}
        short = {unit: ids for unit, ids in made.items() if len(unit) <= LONG}
        self.cache.update(short)
        self.held += 200 * len(short) + sum(4 * len(unit) + len(ids) for unit, ids in short.items())
        return made

    def encode_packed(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, as little-endian 32-bit integers."""
        seen: dict[str, int] = {}
        cut = [array("i", [seen.setdefault(u, len(seen)) for u in units(text)]) for text in texts]
        if self.held > CACHE_BYTES:
            self.cache.clear()
            self.held = 0
        made = self._learn(seen.keys() - self.cache.keys())
        packed = [made[u] if u in made else self.cache[u] for u in seen]
        return [b"".join([packed[i] for i in parts]) for parts in cut]

    def decode_packed(self, packed: bytes) -> bytes:
        ids = array("I")
        ids.frombytes(packed)
        return b"".join(map(self.tokens.__getitem__, ids))


def _leftmost(places: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Of pairs that share a token, the leftmost, then the next that is free."""
    kept, taken = [], -1
    for place, right in zip(places.tolist(), after[places].tolist(), strict=True):
        if place != taken:
            kept.append(place)
            taken = right
    return np.array(kept, dtype=np.int32)


def replay_for(path: str, pattern: str) -> Replay:
    """One per worker process and rank file."""
    return worker_state(("byte_bpe", path, pattern), lambda: Replay(load_ranks(path), pattern))


def encode(docs: DataFrame, path: str, pattern: str, keep: list[str], text: str = "text") -> DataFrame:
    """The `keep` columns and `ids` (array of int), one row per row of `docs`.

    Null and empty texts have no ids; repeated rows stay repeated. `path` names the rank file on every
    executor.
    """
    def worker(texts: list[str | None]) -> dict[str, list]:
        packed = replay_for(path, pattern).encode_packed([t or "" for t in texts])
        return {"ids": [np.frombuffer(p, dtype="<i4") for p in packed]}

    return per_text(docs, keep, text, "ids array<int>", worker)


def decode(encoded: DataFrame, path: str, pattern: str, keep: list[str], ids: str = "ids") -> DataFrame:
    """The `keep` columns and `decoded`, the bytes of the ids; null ids give empty bytes."""
    @F.pandas_udf("binary")
    def decoded(column: pd.Series) -> pd.Series:
        tokens = replay_for(path, pattern).tokens
        return column.map(lambda x: b"" if x is None else b"".join([tokens[i] for i in x]))

    ship(encoded.sparkSession)
    return encoded.select(*keep, decoded(ids).alias("decoded"))


def round_trip(docs: DataFrame, path: str, pattern: str, keep: list[str], text: str = "text") -> DataFrame:
    """Per row: n_tokens, sha256 of the packed ids, sha256 of the bytes that the ids decode to."""
    def worker(texts: list[str | None]) -> dict[str, list]:
        own = replay_for(path, pattern)
        packed = own.encode_packed([t or "" for t in texts])
        return {
            "n_tokens": [len(p) // 4 for p in packed],
            "ids_sha256": [hashlib.sha256(p).hexdigest() for p in packed],
            "decoded_sha256": [hashlib.sha256(own.decode_packed(p)).hexdigest() for p in packed],
        }

    return per_text(docs, keep, text, "n_tokens long, ids_sha256 string, decoded_sha256 string", worker)


def encode_checked(docs: DataFrame, path: str, pattern: str, keep: list[str], text: str = "text") -> DataFrame:
    """Per row: `ids`, n_tokens, and `exact`, whether the decoded ids are the bytes of the text."""
    def worker(texts: list[str | None]) -> dict[str, list]:
        own, texts = replay_for(path, pattern), [t or "" for t in texts]
        packed = own.encode_packed(texts)
        return {
            "ids": [np.frombuffer(p, dtype="<i4") for p in packed],
            "n_tokens": [len(p) // 4 for p in packed],
            "exact": [own.decode_packed(p) == t.encode() for p, t in zip(packed, texts, strict=True)],
        }

    return per_text(docs, keep, text, "ids array<int>, n_tokens long, exact boolean", worker)


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as tokenizers

    return round_trip(read(spark, sf_dir, "documents"), tokenizers.path("byte_bpe_multi_50k.tiktoken"),
                      tokenizers.PATTERN, ["doc_id"])
