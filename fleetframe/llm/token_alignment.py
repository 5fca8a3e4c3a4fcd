"""Alignment of two tokenizers over the same texts, as an Arrow pipeline.

Texts are cut at single blanks between other characters: tokens of neither tokenizer cross such a cut, and tokens of both
end there. So the distinct sections of a block of texts are aligned once. Their token lists are flattened, with parent
indices; cumulative sums of the tokens' bytes, per section, are where tokens end; a hash join on (section, end) finds the
ends that both have, which cut the tokens into groups. Between two neighbouring ends of either tokenizer lies one overlap
of one token of each: a link.

The texts are read and encoded once; their rows are written with the distinct id pairs that each links. Partial counts of
the documents that hold a pair are made per batch, Spark adds them up. The counts are then sent to the tasks (in parts, if
they exceed a bound), which sum them over the stored pairs.
"""

from __future__ import annotations

import hashlib
import os
import re
from array import array
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fleetframe.llm.common import map_arrow, per_text, read, staged, worker_state

#: Bytes of pair counts that are sent to the tasks at a time, and what one pair takes.
COUNT_BYTES, PAIR_BYTES = 64 * 1024 * 1024, 17
#: Sections that the libraries encode as one text, texts that they encode at a time, and rows of partial counts that a
#: task holds before it adds them up.
JOINED, BATCH, HELD_COUNTS = 256, 512, 1_000_000
#: Longer sections go to the library of their file, which is linear in the length of a word.
LONG = 400
BLANK = "▁"
#: The split pattern of byte-level BPE (fixed value).
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_CUT = re.compile(r"(?<=\S) (?=\S)")
_ODD = re.compile(r"\s | \s")
#: Letters up to here are classed alike by all versions of the split pattern.
_LATIN = re.compile(r"[\x00-\u024F]*")
_BYTE = re.compile(r"<0x([0-9A-F]{2})>")


def sections(text: str | None) -> list[str]:
    """The text without the blanks at which it is cut; a null or empty text has no sections."""
    if not text:
        return []
    odd = _ODD.search(text) or text[0] == " " or text[-1] == " "
    return _CUT.split(text) if odd else text.split(" ")


def byte_letters() -> dict[str, int]:
    """The letters that byte-level vocabularies write bytes with: printable ones stand for themselves, the others
    are numbered from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def _strings(count: int, inner: str, last: str) -> list[bytes]:
    return [f"{i}{mark}".encode() for i in range(count) for mark in (inner, last)]


@dataclass
class Aligned:
    """The sections of a block. Arrays have an entry per section; `codes` and `groups` hold lists of them."""

    valid: np.ndarray
    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    codes: pa.ListArray
    groups: pa.LargeBinaryArray


class Aligner:
    """Two tokenizers: A, a byte-level BPE file of `tokenizers`; B, a model file of `sentencepiece`."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        letters, entries = byte_letters(), self.a.get_vocab(with_added_tokens=False)
        self.size_a, self.size_b = self.a.get_vocab_size(with_added_tokens=True), self.b.get_piece_size()
        bytes_a = [b""] * self.size_a
        for entry, i in entries.items():
            bytes_a[i] = bytes([letters[c] for c in entry]) if all(c in letters for c in entry) else entry.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.size_b)]
        bytes_b = [bytes([int(found[1], 16)]) if self.b.is_byte(i) and (found := _BYTE.fullmatch(piece))
                   else piece.replace(BLANK, " ").encode() for i, piece in enumerate(pieces)]
        self.bytes = [pa.array(x, type=pa.large_binary()) for x in (bytes_a, bytes_b)]
        self.lengths = [pc.binary_length(x) for x in self.bytes]
        self.widths = [x.to_numpy() for x in self.lengths]
        # Ids as text, each with what follows it inside a group and at the end of its side.
        self.ranks = self._ranks(entries, letters)
        self.names = pa.array(_strings(self.size_a, ",", "|") + _strings(self.size_b, ",", ";"), type=pa.large_binary())
        self.code_type = pa.int32() if self.size_a * self.size_b < 2**31 else pa.int64()

    def _ranks(self, entries: dict[str, int], letters: dict[str, int]):
        """An encoder by ranks, where the ids of A are in the order of its merges and its split pattern is the known
        one: the same ids, faster; else None."""
        import json

        import tiktoken

        own = json.loads(self.a.to_str())
        split = own["pre_tokenizer"] or {}
        merges = [m if isinstance(m, list) else m.split(" ") for m in own["model"].get("merges", [])]
        plain = split.get("type") == "ByteLevel" and split.get("use_regex") and not split.get("add_prefix_space") and not own["normalizer"]
        if not plain or any(entries.get(a + b) != 256 + i for i, (a, b) in enumerate(merges)) or len(entries) != 256 + len(merges):
            return None
        ranks = {bytes([letters[c] for c in entry]): i for entry, i in entries.items()}
        return tiktoken.Encoding("ranks", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str]) -> tuple[pa.ListArray, pa.ListArray]:
        """Token ids of each section, a blank in front.

        Sections without white space at their ends are encoded joined by single blanks, as texts are cut there; the bytes
        of the tokens tell where each of them ends. Where they do not, and for other sections, one at a time.
        """
        latin, other, alone = [], [], []
        for i, t in enumerate(texts):
            if not t or len(t) > LONG or BLANK in t or t[0].isspace() or t[-1].isspace():
                alone.append(i)
            elif t.isascii() or _LATIN.fullmatch(t):
                latin.append(i)
            else:
                other.append(i)
        made: tuple[list, list] = [], []
        for plain, ranks in ((latin, self.ranks), (other, None)):
            for at in range(0, len(plain), JOINED * BATCH):
                chunks = [plain[i:i + JOINED] for i in range(at, min(at + JOINED * BATCH, len(plain)), JOINED)]
                ids = self._library([" ".join([texts[i] for i in chunk]) for chunk in chunks], ranks)
                for chunk, *own in zip(chunks, *ids, strict=True):
                    own = [np.array(x, dtype=np.int32) for x in own]
                    ends = np.cumsum([len(texts[i].encode()) + 1 for i in chunk])
                    places = [self._places(x, which, ends) for which, x in enumerate(own)]
                    if any(p is None for p in places):
                        alone += chunk
                        continue
                    for found, x, place in zip(made, own, places, strict=True):
                        found.append((chunk, x, place))
        for at in range(0, len(alone), JOINED * BATCH):
            own = alone[at:at + JOINED * BATCH]
            for found, ids in zip(made, self._library([texts[i] for i in own], None), strict=True):
                flat = np.array([x for one in ids for x in one], dtype=np.int32)
                found.append((own, flat, np.cumsum([len(one) for one in ids])))
        return tuple(self._ordered(found, len(texts)) for found in made)

    def _library(self, texts: list[str], ranks) -> tuple[list[list[int]], list[list[int]]]:
        if ranks is not None:
            a = [ranks.encode_ordinary(" " + t) for t in texts]
        else:
            a = [e.ids for e in self.a.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]
        return a, self.b.encode(texts, num_threads=1)

    def _places(self, ids: np.ndarray, which: int, ends: np.ndarray) -> np.ndarray | None:
        """For each end of a section (in bytes) the tokens up to it; None if tokens do not end there."""
        upto = self.widths[which][ids].cumsum()
        place = upto.searchsorted(ends)
        good = len(upto) == place[-1] + 1 and (upto[np.minimum(place, len(upto) - 1)] == ends).all()
        return place + 1 if good else None

    @staticmethod
    def _ordered(found: list, count: int) -> pa.ListArray:
        """Lists of ids in the order of the sections, from (sections, ids, token ends) of parts."""
        if not found:
            return pa.array([[]] * count, type=pa.list_(pa.int32()))
        order = np.concatenate([np.array(own, dtype=np.int64) for own, _, _ in found])
        sizes = np.concatenate([np.diff(place, prepend=0) for _, _, place in found])
        offsets = pa.array(np.append(0, sizes.cumsum()), type=pa.int32())
        lists = pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([ids for _, ids, _ in found])))
        back = np.empty(count, dtype=np.int64)
        back[order] = np.arange(count)
        return lists.take(pa.array(back))

    def _exact(self, lists: pa.ListArray, which: int, texts: list[str]) -> np.ndarray:
        """Whether the bytes of each section's tokens are those of a blank and the section."""
        wanted = [b" " + t.encode() for t in texts]
        made = self.bytes[which].take(lists.flatten())
        data = memoryview(made.buffers()[2]).cast("B") if len(made) and made.buffers()[2] else memoryview(b"")
        offsets = np.frombuffer(made.buffers()[1], dtype=np.int64)[:len(made) + 1] if len(made) else np.zeros(1, dtype=np.int64)
        stops = offsets[lists.offsets.to_numpy()]
        sizes = np.fromiter(map(len, wanted), dtype=np.int64, count=len(wanted))
        same = np.diff(stops) == sizes
        if same.all() and data[:stops[-1]] == b"".join(wanted):
            return same
        return np.array([data[a:b] == w for a, b, w in zip(stops, stops[1:], wanted, strict=False)], dtype=bool)

    def _ends(self, lists: pa.ListArray, which: int) -> tuple[pa.Array, pa.Array, pa.Array]:
        """(ids, parents, keys) of all tokens: the section of each, and the section and byte where it ends as one number."""
        ids, parents = lists.flatten(), pc.list_parent_indices(lists).cast(pa.int64())
        total = pc.cumulative_sum(self.lengths[which].take(ids).cast(pa.int64()))
        before = pa.concat_arrays([pa.array([0], type=pa.int64()), total]).take(lists.offsets)
        ends = pc.subtract(total, before.take(parents))
        return ids, parents, pc.add(pc.shift_left(parents, pa.scalar(32, pa.int64())), ends)

    def align(self, texts: list[str]) -> Aligned:
        lists = self.encode(texts)
        valid = self._exact(lists[0], 0, texts) & self._exact(lists[1], 1, texts)
        if not valid.all():
            # Sections whose bytes differ take no part.
            keep = pa.array(np.where(valid, np.arange(len(texts)), -1))
            keep = pc.if_else(pc.less(keep, 0), None, keep)
            lists = tuple(pc.fill_null(x.take(keep), pa.scalar([], type=x.type)) for x in lists)
        (ids_a, of_a, key_a), (ids_b, of_b, key_b) = (self._ends(x, i) for i, x in enumerate(lists))
        n, n_a, n_b = len(texts), len(ids_a), len(ids_b)
        left = pa.table({"key": key_a, "a": pa.array(np.arange(n_a))})
        right = pa.table({"key": key_b, "b": pa.array(np.arange(n_b))})
        common = left.join(right, "key", join_type="inner", use_threads=False)
        cut_a, cut_b = np.zeros(n_a, dtype=bool), np.zeros(n_b, dtype=bool)
        cut_a[common["a"].to_numpy()] = True
        cut_b[common["b"].to_numpy()] = True
        codes, of_link = self._links(ids_a.to_numpy(), ids_b.to_numpy(), key_a.to_numpy(), key_b.to_numpy(), of_a.to_numpy(), of_b.to_numpy(), cut_b)
        sizes = [np.bincount(x, minlength=n) for x in (of_a.to_numpy(), of_b.to_numpy(), of_a.to_numpy()[cut_a], of_link)]
        offsets = pa.array(np.append(0, sizes[3].cumsum()), type=pa.int32())
        return Aligned(valid, *sizes, pa.ListArray.from_arrays(offsets, pa.array(codes, type=self.code_type)),
                       self._groups(ids_a.to_numpy(), ids_b.to_numpy(), cut_a, cut_b, sizes[0] + sizes[1]))

    def _links(self, ids_a, ids_b, key_a, key_b, of_a, of_b, cut_b) -> tuple[np.ndarray, np.ndarray]:
        """(codes, sections) of all links in the order of the bytes: one for each distinct end of either tokenizer.

        Both lists of ends are in order, so a stable sort merges them; of equal ends that of A comes first and stands for
        both. A token that ends later than the end at hand is the next one of its list.
        """
        order = np.concatenate([key_a, key_b]).argsort(kind="stable")
        from_a = order < len(key_a)
        kept = from_a.copy()
        kept[~from_a] = ~cut_b[order[~from_a] - len(key_a)]
        from_a_kept = from_a[kept]
        a = from_a.cumsum()[kept] - from_a_kept
        b = (~from_a).cumsum()[kept] - ~from_a_kept
        return ids_a[a].astype(np.int64) * self.size_b + ids_b[b], of_a[a]

    def _groups(self, ids_a, ids_b, cut_a, cut_b, sizes) -> pa.LargeBinaryArray:
        """The groups of each section as text, `a1,a2|b1;a3|b2,b3;`, a semicolon at the end."""
        upto_a, upto_b = (np.append(0, np.flatnonzero(cut) + 1) for cut in (cut_a, cut_b))
        group_a, group_b = (cut.cumsum() - cut for cut in (cut_a, cut_b))
        chosen = np.empty(len(ids_a) + len(ids_b), dtype=np.int64)
        chosen[np.arange(len(ids_a)) + upto_b[group_a]] = 2 * ids_a.astype(np.int64) + cut_a
        chosen[np.arange(len(ids_b)) + upto_a[group_b + 1]] = 2 * (self.size_a + ids_b.astype(np.int64)) + cut_b
        names = self.names.take(pa.array(chosen))
        offsets = np.frombuffer(names.buffers()[1], dtype=np.int64)[:len(names) + 1] if len(names) else np.zeros(1, dtype=np.int64)
        stops = offsets[np.append(0, sizes.cumsum())]
        return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(stops.tobytes()), names.buffers()[2] or pa.py_buffer(b"")])


def aligner_for(path_a: str, path_b: str) -> Aligner:
    """One per worker process and pair of files."""
    return worker_state(("token_alignment", path_a, path_b), lambda: Aligner(path_a, path_b))


def _occurrences(texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(distinct sections, number of the section of each occurrence, number of occurrences of each text)."""
    seen: dict[str, int] = {}
    found, sizes = array("q"), np.zeros(len(texts), dtype=np.int64)
    for i, text in enumerate(texts):
        own = sections(text)
        sizes[i] = len(own)
        found.extend([seen.setdefault(s, len(seen)) for s in own])
    return list(seen), np.frombuffer(found, dtype=np.int64) if found else np.zeros(0, dtype=np.int64), sizes


def _only_exact(valid: np.ndarray, found: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Occurrences and sizes without the texts that hold a section which is not exact."""
    if valid.all():
        return found, sizes
    of = np.repeat(np.arange(len(sizes)), sizes)
    good = np.bincount(of[~valid[found]], minlength=len(sizes)) == 0
    return found[good[of]], np.where(good, sizes, 0)


def _sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    total, ends = np.append(0, values.cumsum()), sizes.cumsum()
    return total[ends] - total[ends - sizes]


def _lists(values: pa.Array, parents: np.ndarray, count: int) -> pa.ListArray:
    """Values by parent; parents ascend."""
    offsets = np.append(0, np.bincount(parents, minlength=count).cumsum())
    return pa.ListArray.from_arrays(pa.array(offsets, type=pa.int32()), values)


def align_texts(own: Aligner, texts: list[str | None], show: Callable[[bytes], str]) -> dict[str, object]:
    """Counts of each text, `groups` as `show` makes it of the text of its groups, and the distinct pairs it links:
    `codes`, and `times` with their links."""
    names, found, sizes = _occurrences(texts)
    aligned = own.align(names)
    found, sizes = _only_exact(aligned.valid, found, sizes)
    taken = pa.array(found)
    groups = aligned.groups.take(taken)
    stops = np.frombuffer(groups.buffers()[1], dtype=np.int64)[np.append(0, sizes.cumsum())].tolist() if len(groups) else [0] * (len(sizes) + 1)
    data = memoryview(groups.buffers()[2]).cast("B") if len(groups) and groups.buffers()[2] else memoryview(b"")
    codes = aligned.codes.take(taken)
    of = pa.array(np.repeat(np.arange(len(sizes)), sizes)).take(pc.list_parent_indices(codes))
    pairs = pa.table({"doc": of, "code": codes.flatten()}).group_by(["doc", "code"], use_threads=False).aggregate([([], "count_all")])
    pairs = pairs.sort_by("doc").combine_chunks()
    doc, count = pairs["doc"].to_numpy(), len(sizes)
    code, times = (pc.cast(pairs[c], kind).combine_chunks() for c, kind in (("code", own.code_type), ("count_all", pa.int32())))
    return {
        **{name: _sums(getattr(aligned, name)[found], sizes).tolist() for name in ("n_a", "n_b", "n_groups", "n_links")},
        "groups": [show(bytes(data[a:b - 1])) if b > a else "" for a, b in zip(stops, stops[1:], strict=False)],
        "codes": _lists(code, doc, count),
        "times": _lists(times, doc, count),
    }


def linked_pairs(docs: DataFrame, path_a: str, path_b: str, keep: list[str], text: str, show: Callable[[bytes], str]) -> DataFrame:
    """Per row of `docs`: the `keep` columns and what `align_texts` makes of its text."""
    code = "int" if Aligner(path_a, path_b).code_type == pa.int32() else "bigint"
    schema = f"n_a long, n_b long, n_groups long, n_links long, groups string, codes array<{code}>, times array<int>"
    return per_text(docs, keep, text, schema, lambda texts: align_texts(aligner_for(path_a, path_b), texts, show))


def _added(tables: list[pa.Table]) -> pa.Table:
    return pa.concat_tables(tables).group_by("code", use_threads=False).aggregate([("docs", "sum")]).rename_columns(["code", "docs"])


def pair_counts(linked: DataFrame) -> DataFrame:
    """(code, docs): in how many rows a pair of ids is linked."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, out = [], pa.schema([("code", pa.int64()), ("docs", pa.int64())])
        for batch in batches:
            flat = pa.table({"code": batch.column("codes").flatten().cast(pa.int64())})
            held.append(flat.group_by("code", use_threads=False).aggregate([([], "count_all")]).rename_columns(["code", "docs"]))
            if sum(map(len, held)) > HELD_COUNTS:
                held = [_added(held)]
                if len(held[0]) > HELD_COUNTS // 2:
                    yield from held.pop().cast(out).combine_chunks().to_batches()
        if held:
            yield from _added(held).cast(out).combine_chunks().to_batches()

    partial = map_arrow(linked.select("codes"), run, "code long, docs long")
    return partial.groupBy("code").agg(F.sum("docs").alias("docs"))


def with_counts(linked: DataFrame, size_b: int, bound: int) -> DataFrame:
    """`linked` with n_best and count_sum: links whose pair is the most frequent of its A id, and the counts over all links."""
    spark = linked.sparkSession
    counts = staged(pair_counts(linked), "pair-counts")
    # An A id has at most `size_b` pairs.
    of_a = Window.partitionBy(F.floor(F.col("code") / size_b))
    top = counts.withColumn("best", F.col("docs") == F.max("docs").over(of_a))
    parts = max(1, -(-counts.count() * PAIR_BYTES // bound))
    made = linked.withColumns({"n_best": F.lit(0).cast("long"), "count_sum": F.lit(0).cast("long")})
    for part in range(parts):
        rows = top.where(F.pmod("code", F.lit(parts)) == part).select("code", "docs", "best").toArrow().sort_by("code").combine_chunks()
        sent = spark.sparkContext.broadcast(tuple(rows[c].to_numpy() for c in ("code", "docs", "best")))
        made = map_arrow(made, _adder(sent), made.schema)
    return made


def _adder(sent) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, docs, best = sent.value
        for batch in batches:
            lists = batch.column("codes")
            codes, times = lists.flatten().to_numpy(), batch.column("times").flatten().to_numpy().astype(np.int64)
            sizes = np.diff(lists.offsets.to_numpy())
            at = np.minimum(known.searchsorted(codes), max(len(known) - 1, 0))
            hit = known[at] == codes if len(known) else np.zeros(len(codes), dtype=bool)
            for name, values in (("n_best", best), ("count_sum", docs)):
                added = np.where(hit, values[at], 0) * times if len(known) else times * 0
                place = batch.schema.get_field_index(name)
                total = batch.column(place).to_numpy() + _sums(added.astype(np.int64), sizes)
                batch = batch.set_column(place, name, pa.array(total))
            yield batch

    return run


def _aligned(docs: DataFrame, path_a: str, path_b: str, keep: list[str], text: str, bound: int, show: Callable[[bytes], str]) -> DataFrame:
    # The columns of the result may have any names in `docs`.
    own = {c: f"_{i}" for i, c in enumerate(keep)}
    source = docs.select(*[F.col(c).alias(name) for c, name in own.items()], F.col(text).alias("text"))
    linked = staged(linked_pairs(source, path_a, path_b, list(own.values()), "text", show), "linked")
    made = with_counts(linked, Aligner(path_a, path_b).size_b, bound)
    return made.select(*[F.col(name).alias(c) for c, name in own.items()], "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups")


def alignment(docs: DataFrame, path_a: str, path_b: str, keep: list[str], text: str = "text", bound: int = COUNT_BYTES) -> DataFrame:
    """Per row of `docs`: the `keep` columns, n_a, n_b, n_groups, n_links, n_best, count_sum and `groups`.

    A encodes a blank and the text, B the text (it adds the blank itself); strings of special tokens are plain text. Null
    and empty texts, and those whose tokens do not give back the bytes of the text, have no tokens: zeros and empty groups.
    Every row counts as a document, repeated ones too. `groups` writes the ids, groups parted by semicolons. The pair counts
    are sent to the tasks in parts of about `bound` bytes.
    """
    return _aligned(docs, path_a, path_b, keep, text, bound, bytes.decode)


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as tokenizers

    found = _aligned(read(spark, sf_dir, "documents"), tokenizers.path("byte_bpe_50k.json"), tokenizers.path("piece_bpe_32k.model"),
                     ["doc_id"], "text", COUNT_BYTES, lambda groups: hashlib.sha256(groups).hexdigest())
    return found.withColumnRenamed("groups", "groups_sha256")
