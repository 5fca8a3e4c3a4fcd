"""Quality rules: plain counts, and repetition found with suffix arrays.

Suffixes begin at words. A block of texts has one suffix array, made by prefix doubling: ranks of runs of 1, 2,
4, ... words, each round only over the suffixes that still share their rank. A word is numbered within its text, so
suffixes of different texts never share one. The common prefix of neighbours in the array follows from the ranks of the
rounds. The deepest interval of common prefixes around a suffix is the longest substring that begins there and occurs
elsewhere in the text; one that the repeat of the word before already covers is not maximal. The spans of the maximal
repeats are united: the covered share of the words and the longest repeat are limited.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetframe.llm.common import named, per_text, read, row_key, unused

#: Base rules: least words, and the greatest share (in percent) of words in repeated windows of WINDOW words.
MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW = 50, 50, 3
#: Rules of the method: repeats of at least MIN_REPEAT words may cover MAX_COVERED of the words; the longest
#: repeat may have LONGEST_WORDS words, or MAX_LONGEST of the words if those are more.
MIN_REPEAT, MAX_COVERED = 5, 0.3
LONGEST_WORDS, MAX_LONGEST = 50, 0.1
SYMBOLS, BLANKS = b"#*$%&|<>", b" \t\n\v\f\r"
_BLANKS = BLANKS.decode()

COUNTS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
REPEATS = "n_covered long, longest_repeat long"


def number_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(codes, sizes): all words of the texts as numbers that two texts never share; the words of each text."""
    codes, sizes, base = [], np.zeros(len(texts), dtype=np.int64), 0
    for i, text in enumerate(texts):
        words = text.split()
        seen = dict.fromkeys(words)
        for n, word in enumerate(seen, base):
            seen[word] = n
        codes.append(np.fromiter(map(seen.__getitem__, words), dtype=np.int32, count=len(words)))
        sizes[i], base = len(words), base + len(seen)
    return (np.concatenate(codes) if codes else np.zeros(0, dtype=np.int32)), sizes


def longest_repeats(codes: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """For each position the words of the longest run that begins there and also elsewhere in its text, 0 or 1 for
    runs of under two words. `stops` has for each position the end of its text."""
    n = len(codes)
    longest = np.zeros(n, dtype=np.int32)
    if not n:
        return longest
    sizes = np.bincount(codes)
    rank = (sizes.cumsum() - sizes)[codes].astype(np.int32)
    active = np.flatnonzero(sizes[codes] > 1)
    # One more rank at the end: no suffix has it.
    levels, width, paired = [np.append(rank, -1)], 1, None
    while len(active):
        beyond = active + width
        second = np.where(beyond < stops[active], levels[-1][np.minimum(beyond, n)], -1).astype(np.int64)
        key = levels[-1][active].astype(np.int64) * (n + 1) + second + 1
        order = key.argsort(kind="stable")
        active, key = active[order], key[order]
        first = levels[-1][active]
        place = np.arange(len(active))
        opens = np.append(True, key[1:] != key[:-1])
        group = np.append(True, first[1:] != first[:-1])
        start = np.maximum.accumulate(np.where(opens, place, 0))
        offset = start - np.maximum.accumulate(np.where(group, place, 0))
        made = levels[-1].copy()
        made[active] = first + offset
        levels.append(made)
        alone = opens & np.append(opens[1:], True)
        active, width = active[~alone], 2 * width
        if paired is None:
            paired = active
    if paired is None or not len(paired):
        return longest
    paired = paired[levels[-1][paired].argsort(kind="stable")]
    left, right = paired[:-1].copy(), paired[1:].copy()
    same = levels[1][left] == levels[1][right]
    left, right = left[same], right[same]
    a, b, common = left.copy(), right.copy(), np.zeros(len(left), dtype=np.int32)
    for level in range(len(levels) - 1, -1, -1):
        # Equal ranks of a round mean equal words, all of them: a suffix cut by its end shares its rank with none.
        step = np.where(levels[level][a] == levels[level][b], 1 << level, 0)
        a, b, common = a + step, b + step, common + step.astype(np.int32)
    longest[left] = common
    longest[right] = np.maximum(longest[right], common)
    return longest


def covered(starts: np.ndarray, ends: np.ndarray, n: int) -> np.ndarray:
    """Whether each of `n` positions lies in one of the spans."""
    change = np.bincount(starts, minlength=n + 1) - np.bincount(ends, minlength=n + 1)
    return change.cumsum()[:n] > 0


def maximal_repeats(longest: np.ndarray, begins: np.ndarray, least: int) -> np.ndarray:
    """Positions where a maximal repeat of at least `least` words begins; `begins` are the first ones of texts."""
    before = np.append(0, longest[:-1])
    before[begins[begins < len(longest)]] = 0
    return np.flatnonzero((longest >= least) & (before <= longest))


def _per_text(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    total = np.append(0, values.cumsum())
    ends = sizes.cumsum()
    return total[ends] - total[ends - sizes]


def judge_texts(texts: list[str | None], least: int = MIN_REPEAT) -> dict[str, list]:
    """The columns of COUNTS and REPEATS, and `spans`, the united spans of the maximal repeats in words."""
    plain = [t or "" for t in texts]
    raw = [t.encode() for t in plain]
    codes, sizes = number_words(raw)
    ends = sizes.cumsum()
    begins = ends - sizes
    longest = longest_repeats(codes, np.repeat(ends, sizes))
    windows = np.flatnonzero(longest >= WINDOW)
    repeated = covered(windows, windows + WINDOW, len(codes))
    maximal = maximal_repeats(longest, begins, least)
    inside = covered(maximal, maximal + longest[maximal], len(codes))
    top = np.zeros(len(texts), dtype=np.int64)
    if len(longest):
        top[sizes > 0] = np.maximum.reduceat(longest, begins[sizes > 0])
    # Spans end where a covered word is followed by another text or by a word that is not covered.
    first = inside.copy()
    if len(first):
        edge = np.zeros(len(first), dtype=bool)
        edge[begins[sizes > 0]] = True
        first[1:] &= ~inside[:-1] | edge[1:]
        last = inside & np.append(~inside[1:] | edge[1:], True)
    else:
        last = first
    opened, closed = np.flatnonzero(first), np.flatnonzero(last) + 1
    of = ends.searchsorted(opened, side="right")
    spans: list[list[dict[str, int]]] = [[] for _ in texts]
    for i, start, stop in zip(of.tolist(), opened.tolist(), closed.tolist(), strict=True):
        spans[i].append({"start": start - int(begins[i]), "stop": stop - int(begins[i])})
    lines = [[x for x in t.split("\n") if x.strip(_BLANKS)] if "\n" in t else [] for t in plain]
    return {
        "n_words": sizes.tolist(),
        "word_chars": [len(t) - (len(b) - len(b.translate(None, BLANKS))) for t, b in zip(plain, raw, strict=True)],
        "n_symbols": [len(b) - len(b.translate(None, SYMBOLS)) for b in raw],
        "n_dup_lines": [len(x) - len(set(x)) for x in lines],
        "n_repeat_words": _per_text(repeated.astype(np.int64), sizes).tolist(),
        "n_covered": _per_text(inside.astype(np.int64), sizes).tolist(),
        "longest_repeat": top.tolist(),
        "spans": spans,
    }


def quality(docs: DataFrame, keep: list[str], text: str = "text", least: int = MIN_REPEAT, max_covered: float = MAX_COVERED,
            longest_words: int = LONGEST_WORDS, max_longest: float = MAX_LONGEST) -> DataFrame:
    """Per row of `docs`: the `keep` columns, counts, base_failed, kept, n_covered, longest_repeat and `spans`.

    `spans` are (start, stop) in words, stop exclusive: what maximal repeats of at least `least` words cover. A repeat
    of one word counts as no longest repeat. Null and empty texts have no words, so they fail the base rule. Every row
    is judged by its own text; repeated rows stay repeated. Other columns, whatever their names, do not take part.
    """
    def worker(texts: list[str | None]) -> dict[str, list]:
        return judge_texts(texts, least)

    found = per_text(docs, keep, text, f"{COUNTS}, {REPEATS}, spans array<struct<start: long, stop: long>>", worker)
    words = F.col("n_words")
    failed = (words < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * words)
    good = (F.col("n_covered") <= max_covered * words) & (F.col("longest_repeat") <= F.greatest(F.lit(longest_words), max_longest * words))
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return found.select(*named(found, *keep), *counts, failed.alias("base_failed"), (~failed & good).alias("kept"),
                        "n_covered", "longest_repeat", "spans")


def drop_low_quality(docs: DataFrame, text: str = "text", **limits: float) -> DataFrame:
    """`docs` without the rows whose text is not kept; columns unchanged. Equal texts are judged alike."""
    key = unused(docs, "_key")
    source = docs.withColumn(key, row_key(text))
    texts = source.select(F.col(key).alias("key"), named(source, text)[0].alias("text"))
    bad = quality(texts, ["key"], "text", **limits).where("NOT kept").select(F.col("key").alias(key)).distinct()
    return source.join(bad, key, "left_anti").select(*named(docs))


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(read(spark, sf_dir, "documents"), ["doc_id"]).drop("spans")
