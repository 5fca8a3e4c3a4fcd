"""Token counts of a BPE with word marks, exact at every prefix of a text.

The last token of a prefix is the only piece that ends there and that the merges would leave standing
next to the last token of what comes before it. So one pass over a unit (a word with the blanks before
it) stores the count at each of its prefixes, and counts, truncation points and budget questions are
answered from the stored counts without encoding again. No piece has a blank behind another character,
so units are independent and their counts add up. Inside a unit the text is cut further, between two
characters that no piece holds next to each other: text without blanks becomes short parts.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterable, Iterator
from itertools import chain

from pyspark.sql import DataFrame, SparkSession

from fleetframe.llm.common import per_text, read, worker_state

#: About the bytes of Python objects that a worker keeps, in two generations: what the older one holds
#: and is asked for again moves to the newer. Units of more than LONG characters are not kept as a whole.
CACHE_BYTES = 160_000_000
LONG, PLAIN, TAIL = 48, 24, 4
PAIR_CACHE = 500_000
BLANK = "▁"
_UNIT = re.compile(r" *[^ ]+| +$")


def units(text: str) -> list[str]:
    """The marked text, cut before each run of blanks. The first blank of every unit is left out."""
    text = text.replace(BLANK, " ")
    if not text:
        return []
    if "  " in text or text[0] == " " or text[-1] == " ":
        return [unit[1:] for unit in _UNIT.findall(" " + text)]
    return text.split(" ")


class PrefixCounter:
    """Counts with the pieces of one model file."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        special = (model.is_control, model.is_unknown, model.is_byte, model.is_unused)
        #: Merges go by falling score; of equal scores (the runs of blanks) the leftmost pair is first.
        self.rank = {
            model.id_to_piece(i).replace(BLANK, " "): -model.get_score(i)
            for i in range(model.get_piece_size()) if not any(kind(i) for kind in special)
        }
        self.joined = {piece[i:i + 2] for piece in self.rank for i in range(len(piece) - 1)}
        self.ends: dict[str, list[int]] = {}
        for piece in sorted(self.rank, key=len, reverse=True):
            if len(piece) > TAIL:
                self.ends.setdefault(piece[-TAIL:], []).append(len(piece))
        self.candidates: dict[str, tuple[tuple[int, str | None], ...]] = {}
        self.split: dict[str, tuple[str, str] | None] = {}
        self.stands: dict[tuple[str, str], bool] = {}
        self.parts: dict[str, bytes | array] = {}
        self.totals: dict[str, int] = {}
        self.older: tuple[dict[str, bytes | array], dict[str, int]] = {}, {}
        self.held = 0

    def merged(self, text: str) -> list[str]:
        """The tokens of a short text by its merges: best piece first, leftmost first."""
        return self._merge(text)[0]

    def _merge(self, text: str) -> tuple[list[str], tuple[str, str] | None]:
        """The tokens of a short text and its last merge."""
        parts, halves = list(text), None
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                rank = self.rank.get(parts[i] + parts[i + 1])
                if rank is not None and (best is None or rank < best):
                    best, at = rank, i
            if best is None:
                return parts, halves
            halves = parts[at], parts[at + 1]
            parts[at:at + 2] = [parts[at] + parts[at + 1]]

    def _halves(self, piece: str) -> tuple[str, str] | None:
        """The two tokens whose merge makes the piece; None if its own merges do not end in it."""
        if piece not in self.split:
            tokens, halves = self._merge(piece)
            self.split[piece] = halves if len(tokens) == 1 else None
        return self.split[piece]

    def _stand(self, left: str, right: str) -> bool:
        """Whether the merges of `left + right` end in just these two tokens."""
        if len(self.stands) >= PAIR_CACHE:
            self.stands.clear()
        known = self.stands[left, right] = self._apart(left, right) if left else self.merged(right) == [right]
        return known

    def _apart(self, left: str, right: str) -> bool:
        """No merge across the border comes before those that make the two tokens.

        Both are undone, the later merge first; a merge of what then meets at the border must not be earlier than the
        merge undone last. Of equal ranks the leftmost is first. Runs of blanks share one rank: merged out.
        """
        if "  " in left or "  " in right:
            return self.merged(left + right) == [left, right]
        if any(len(x) > 1 and self._halves(x) is None for x in (left, right)):
            return False
        limit, rank = float("inf"), self.rank
        while True:
            across = rank.get(left + right)
            if across is not None and across < limit:
                return False
            if len(left) == 1 and len(right) == 1:
                return True
            if len(right) == 1 or len(left) > 1 and rank[left] > rank[right]:
                limit, left = rank[left], self._halves(left)[1]
            else:
                limit, right = rank[right] + 0.5, self._halves(right)[0]

    def _candidates(self, tail: str) -> tuple[tuple[int, str | None], ...]:
        """(length, piece) of the pieces that may end with these last characters, longest first.

        Of pieces longer than the tail only the length is known; a single character always stands last.
        """
        found = [(n, None) for n in self.ends.get(tail, ())]
        found += [(n, tail[-n:]) for n in range(len(tail), 1, -1) if tail[-n:] in self.rank]
        if len(self.candidates) >= PAIR_CACHE:
            self.candidates.clear()
        made = self.candidates[tail] = (*found, (1, tail[-1]))
        return made

    def cut(self, unit: str) -> list[str]:
        """The unit cut where no piece spans two neighbouring characters; a short word stays whole."""
        if len(unit) <= PLAIN and unit[1:].isalpha():
            return [unit]
        joined, found, start = self.joined, [], 0
        for i in range(1, len(unit)):
            if unit[i - 1:i + 1] not in joined:
                found.append(unit[start:i])
                start = i
        found.append(unit[start:])
        return found

    def counted(self, parts: Iterable[str]) -> Iterator[tuple[str, bytes | array]]:
        """(part, number of tokens of each of its prefixes), parts in sorted order.

        In that order a part goes on from the prefix that it shares with the one before it.
        """
        rank, known, candidates = self.rank, self.stands, self.candidates
        counts, last, previous = [0], [""], ""
        for part in sorted(parts):
            shared, most = 0, min(len(part), len(previous))
            while shared < most and part[shared] == previous[shared]:
                shared += 1
            del counts[shared + 1:], last[shared + 1:]
            for end in range(shared + 1, len(part) + 1):
                tail = part[end - TAIL if end > TAIL else 0:end]
                for length, piece in candidates.get(tail) or self._candidates(tail):
                    start = end - length
                    if piece is None:
                        piece = part[start:end]
                        if start < 0 or piece not in rank:
                            continue
                    left = last[start]
                    stands = known.get((left, piece))
                    if stands is None:
                        stands = self._stand(left, piece)
                    if stands:
                        break
                last.append(piece)
                # A character without a piece falls back to one token for each of its bytes.
                counts.append(counts[start] + (1 if piece in rank else len(piece.encode())))
            yield part, bytes(counts[1:]) if counts[-1] < 256 else array("q", counts[1:])
            previous = part

    def _prefixes(self, part: str) -> bytes | array:
        """The stored counts of a part; those of a long one, or one that is gone, are made anew."""
        known = self.parts.get(part) or self.older[0].get(part)
        return known if known is not None else next(self.counted([part]))[1]

    def learn(self, new: set[str]) -> None:
        """Store the counts of new units and of their parts, the long ones left out."""
        old_parts, old_totals = self.older
        again = new & old_totals.keys()
        self.totals.update((unit, old_totals[unit]) for unit in again)
        cut = {unit: self.cut(" " + unit) for unit in new - again}
        parts = {part for part in chain.from_iterable(cut.values()) if len(part) <= LONG} - self.parts.keys()
        known = parts & old_parts.keys()
        self.parts.update((part, old_parts[part]) for part in known)
        self.parts.update(self.counted(parts - known))
        short = {unit: found for unit, found in cut.items() if len(unit) <= LONG}
        self.totals.update((unit, sum([self._prefixes(p)[-1] for p in found])) for unit, found in short.items())
        self.held += 200 * (len(again) + len(short) + len(parts)) + 4 * sum(map(len, chain(again, short, parts)))

    def total(self, unit: str) -> int:
        """Tokens of a unit, stored or (of a long one) counted part by part."""
        known = self.totals.get(unit)
        return known if known is not None else sum([self._prefixes(p)[-1] for p in self.cut(" " + unit)])

    def counts(self, texts: list[str]) -> list[tuple[list[str], int]]:
        """The units of each text and its number of tokens."""
        cut = [units(text) for text in texts]
        needed: set[str] = set()
        for parts in cut:
            needed.update(parts)
        if 2 * self.held > CACHE_BYTES:
            self.older = self.parts, self.totals
            self.parts, self.totals, self.held = {}, {}, 0
        self.learn(needed - self.totals.keys())
        get, made = self.totals.__getitem__, []
        for parts in cut:
            try:
                made.append((parts, sum(map(get, parts))))
            except KeyError:
                made.append((parts, sum(map(self.total, parts))))
        return made

    def prefixes(self, unit: str) -> list[int]:
        """Tokens of each prefix of a unit, its first blank included."""
        made, before = [], 0
        for part in self.cut(" " + unit):
            made += [before + n for n in self._prefixes(part)]
            before = made[-1]
        return made

    def within(self, parts: list[str], limit: int) -> int:
        """Characters of the longest prefix of a text with at most `limit` tokens; `parts` are its units."""
        before, at = 0, -1  # the mark in front is no character of the text
        for unit in parts:
            total = self.total(unit)
            if before + total > limit:
                fitting = [i for i, n in enumerate(self.prefixes(unit), 1) if before + n <= limit]
                return max(0, at + fitting[-1]) if fitting else max(0, at)
            before += total
            at += len(unit) + 1
        return max(0, at)


def counter_for(path: str) -> PrefixCounter:
    """One per worker process and model file."""
    return worker_state(("token_counts", path), lambda: PrefixCounter(path))


def token_counts(docs: DataFrame, path: str, limit: int, keep: list[str], text: str = "text") -> DataFrame:
    """Per row of `docs`: n_bytes, n_tokens, over_limit, and n_chars_within, the truncation point.

    Null counts as empty: 0 tokens. Repeated rows stay repeated. `path` names the model file on every
    executor; `n_chars_within` is the length of the longest prefix with at most `limit` tokens.
    """
    def worker(texts: list[str | None]) -> dict[str, list]:
        own, texts = counter_for(path), [t or "" for t in texts]
        found = own.counts(texts)
        return {
            "n_bytes": [len(t.encode()) for t in texts],
            "n_tokens": [n for _, n in found],
            "over_limit": [n > limit for _, n in found],
            "n_chars_within": [
                own.within(parts, limit) if n > limit else len(t) for t, (parts, n) in zip(texts, found, strict=True)
            ],
        }

    return per_text(docs, keep, text, "n_bytes long, n_tokens long, over_limit boolean, n_chars_within long", worker)


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as tokenizers

    return token_counts(read(spark, sf_dir, "documents"), tokenizers.path("piece_bpe_32k.model"), 4096, ["doc_id"])
