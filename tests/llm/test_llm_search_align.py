"""Alignment, lexical search and quality rules against brute force; nulls, ties, repeated rows, empty tables, clashing names."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import compare
import public_tokenizers as tokenizers
import pytest
from pyspark.sql import functions as F

from fleetframe.llm import lexical_search, quality_rules, token_alignment
from fleetframe.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
PATH_A, PATH_B = tokenizers.path("byte_bpe_50k.json"), tokenizers.path("piece_bpe_32k.model")
HARD = [None, "", " ", "  a", "a  b ", "\n\n a\t b", "don't 's  x's \x1c y", "aaaa" * 200, "日本語テキスト é́", " \n x", "a \x85b",
        "<|endoftext|> hi", "<s>hi</s> <0x0A>", "▁x▁▁y", "\x00a", "ﬁ Ⅳ ü🎉", " " * 37, "x" * 600, "ab" * 300 + " end", "ok ▁ no",
        "the cat the cat", "the cat", "the cat"]


# --- alignment -----------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(PATH_A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=PATH_B)


def spans(ids, token_bytes):
    found, at = [], 0
    for i in ids:
        found.append((at, at + len(token_bytes(i)), i))
        at = found[-1][1]
    return found


def plain_alignment(texts, libraries):
    """The contract, text by text and token by token."""
    a, b = libraries
    entries, letters = {i: e for e, i in a.get_vocab().items()}, token_alignment.byte_letters()

    def bytes_a(i):
        return bytes(letters[c] for c in entries[i]) if all(c in letters for c in entries[i]) else entries[i].encode()

    def bytes_b(i):
        piece = b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()

    made, pairs = [], Counter()
    for text in texts:
        wanted = (" " + text).encode() if text else b""
        ids = (a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)) if text else ([], [])
        if not text or b"".join(map(bytes_a, ids[0])) != wanted or b"".join(map(bytes_b, ids[1])) != wanted:
            made.append(None)
            continue
        left, right = spans(ids[0], bytes_a), spans(ids[1], bytes_b)
        links = [(x[2], y[2]) for x in left for y in right if x[0] < y[1] and y[0] < x[1]]
        groups, before = [], 0
        for cut in sorted({x[1] for x in left} & {y[1] for y in right}):
            groups.append("|".join(",".join(str(x[2]) for x in side if before < x[1] <= cut) for side in (left, right)))
            before = cut
        pairs.update(set(links))
        made.append((len(left), len(right), len(groups), links, ";".join(groups)))
    best = defaultdict(int)
    for (first, _), n in pairs.items():
        best[first] = max(best[first], n)
    return [(0, 0, 0, 0, 0, 0, "") if m is None else
            (*m[:3], len(m[3]), sum(pairs[x] == best[x[0]] for x in m[3]), sum(pairs[x] for x in m[3]), m[4]) for m in made]


@pytest.mark.parametrize("bound", [token_alignment.COUNT_BYTES, 10_000])
def test_alignment(spark, libraries, bound):
    made = random.Random(3)
    parts = ["the", "ing", "é", "日", " ", " ", "  ", "\n", "x9", "Hello", ".", ", ", "🎉", "don't"]
    texts = HARD + ["".join(made.choices(parts, k=made.randint(0, 20))) for _ in range(150)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    found = {r.doc_id: tuple(r)[1:] for r in token_alignment.alignment(docs, PATH_A, PATH_B, ["doc_id"], bound=bound).collect()}
    assert found == dict(enumerate(plain_alignment(texts, libraries)))


def test_alignment_query(spark, libraries):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    found = {r.doc_id: tuple(r)[1:] for r in QUERIES["op11_token_alignment"](spark, SF_DIR).collect()}
    # Links are counted pair by pair here: texts of moderate length.
    wanted = dict(zip([r.doc_id for r in docs], plain_alignment([r.text if len(r.text or "") < 6000 else None for r in docs], libraries), strict=True))
    short = [r.doc_id for r in docs if len(r.text or "") < 6000]
    assert len(short) > 150
    for i in short:
        groups = wanted[i][6]
        assert found[i][:4] == wanted[i][:4]
        assert found[i][6] == (hashlib.sha256(groups.encode()).hexdigest() if groups else "")
        # The long texts, left out above, only add to the counts.
        assert found[i][5] >= wanted[i][5]


def test_alignment_frames(spark):
    docs = spark.createDataFrame([(1, "a b", "x"), (1, "a b", "x"), (None, None, "y")], "doc_id long, text string, _body string")
    docs = docs.withColumn("_text", F.lit(1)).withColumn("_best_0", F.lit(2))
    found = token_alignment.alignment(docs, PATH_A, PATH_B, ["doc_id", "_best_0"])
    assert sorted(tuple(r)[:3] for r in found.where("doc_id = 1").collect()) == [(1, 2, 2), (1, 2, 2)]
    assert found.where("doc_id IS NULL").first().groups == ""
    assert token_alignment.alignment(docs.limit(0), PATH_A, PATH_B, ["doc_id"]).count() == 0


# --- search ----------------------------------------------------------------------------------------

TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_terms(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return TERM.findall(lower)


def plain_search(docs, items, k):
    terms = [(i, Counter(plain_terms(text))) for i, text in docs]
    n_docs, length = sum(bool(t) for _, t in terms), sum(sum(t.values()) for _, t in terms)
    df = Counter(term for _, t in terms for term in t)
    rows = []
    for item, text in dict.fromkeys(items):
        scored = []
        for i, own in terms:
            m = 75 + (25 * sum(own.values()) * n_docs) // max(length, 1)
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * own[t]) // (1000 * own[t] + 12 * m))
                        for t in plain_terms(text) if t in own)
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        rows += [(item, rank, i, -score) for rank, (score, _, _, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(rows, key=str)


def made_texts(seed, n, words=30):
    made = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)] + ["É", "été", "the", "THE", "日本", "a1"]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    return [" ".join(made.choices(vocabulary, weights, k=made.randint(0, words))) + made.choice(["", ".", "\x7fend"]) for _ in range(n)]


@pytest.mark.parametrize("bound", [lexical_search.BROADCAST_BYTES, 3_000])
def test_search(spark, bound, monkeypatch):
    monkeypatch.setattr(lexical_search, "BLOCK_POSTINGS", 500)
    docs = list(enumerate(made_texts(1, 400))) + [(500 + i, "w3 w4 the copy") for i in range(50)] + [(None, "w3 w4"), (7, "w3 w4"), (900, None), (901, "")]
    items = list(enumerate(made_texts(2, 30, 12))) + [(0, "w3 w4 the copy"), (77, None), (78, "..."), (79, "unheard of"), (None, "w1 w1 w2")]
    items.append(items[0])
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(5).withColumn("term", F.lit(1)).withColumn("_salt", F.lit(1))
    i = spark.createDataFrame(items, "item_id long, text string").withColumn("words", F.lit("x"))
    found = lexical_search.search(d, i, 5, bound=bound)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, found.collect()), key=str) == plain_search(docs, items, 5)


def test_accumulators_are_limited():
    """New accumulators stop, and the result is that of all lists."""
    import numpy as np

    made = random.Random(5)
    lists = [sorted(made.sample(range(3000), k)) for k in (5, 25, 400, 1500, 2900)]
    rows = sorted((doc, term, made.randint(1, 3)) for term, own in enumerate(lists) for doc in own)
    sizes = np.full(3000, 40)
    counts = Counter(doc for doc, _, _ in rows)
    offsets = np.append(0, np.cumsum([counts[i] for i in range(3000)]))
    block = lexical_search.Block(sizes, offsets, np.array([t for _, t, _ in rows]), np.array([n for _, _, n in rows]), (3000, 120_000))
    weights = (9000, 7000, 3000, 900, 40)
    stats = {}
    found, scores = block.search(lexical_search.Query(0, (0, 1, 2, 3, 4), weights), 10, 1, stats)
    total = Counter()
    for doc, term, n in rows:
        total[doc] += weights[term] * ((10**9 * n) // (1000 * n + 12 * 100))
    kth = sorted(total.values(), reverse=True)[9]
    assert dict(zip(found.tolist(), scores.tolist(), strict=True)) == {d: s for d, s in total.items() if s >= kth}
    assert stats["skipped"] > stats["updated"] > 0


def test_search_empty(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    items = spark.createDataFrame([("q", "b c")], "item_id string, text string")
    assert [tuple(r)[:3] for r in lexical_search.search(docs, items).collect()] == [("q", 1, 1)]
    assert lexical_search.search(docs.limit(0), items).collect() == []
    assert lexical_search.search(docs, items.limit(0)).collect() == []


def test_search_text_ids(spark):
    docs = spark.createDataFrame([(x, "a b") for x in "zyxwv"], "doc_id string, text string").repartition(3)
    items = spark.createDataFrame([(1, "b")], "item_id long, text string")
    other = docs.union(spark.createDataFrame([("q", "c")] * 9, docs.schema))
    assert [r.doc_id for r in lexical_search.search(other, items, 3).orderBy("rank").collect()] == ["v", "w", "x"]


# --- quality rules -----------------------------------------------------------------------------------


def plain_quality(text, least):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    n, windows, repeated = len(words), defaultdict(list), set()
    for i in range(n - 2):
        windows[tuple(words[i:i + 3])].append(i)
    for places in windows.values():
        repeated |= {j for i in places for j in range(i, i + 3) if len(places) > 1}
    longest = [0] * n
    for i in range(n):
        for j in range(n):
            size = 0
            while i != j and max(i, j) + size < n and words[i + size] == words[j + size]:
                size += 1
            longest[i] = max(longest[i], size)
    covered = {j for i in range(n) if longest[i] >= least for j in range(i, i + longest[i])}
    lines, seen, equal = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)], set(), 0
    for line in lines:
        equal += line in seen
        seen.add(line)
    return {"n_words": n, "word_chars": sum(map(len, words)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text)), "n_dup_lines": equal,
            "n_repeat_words": len(repeated), "n_covered": len(covered), "longest_repeat": max([x for x in longest if x > 1], default=0)}, covered


def test_quality_counts():
    made = random.Random(2)
    texts = [None, "", "a", " \n\t", "a a a a a a", "x y z x y z", "é#$ a\x1cb\nq\nq\n \n \n", "a\x85b a\x85b"]
    texts += ["".join(made.choice(["a", "b", "c", "é", "#x"]) + made.choice([" ", " ", "\n", "  "]) for _ in range(made.randint(0, 30))) for _ in range(400)]
    for least in (3, 5):
        found = quality_rules.judge_texts(texts, least)
        for i, text in enumerate(texts):
            wanted, covered = plain_quality(text, least)
            assert {k: found[k][i] for k in wanted} == wanted
            assert {j for s in found["spans"][i] for j in range(s["start"], s["stop"])} == covered


def test_quality_verdicts(spark):
    made = random.Random(4)
    clean = " ".join(str(made.randint(0, 10**6)) for _ in range(300))
    short, long_ = clean[:500], clean[:1200]
    texts = {"clean": clean, "short": "a b c", "null": None, "empty": "", "copy": clean + " " + clean, "passage": clean + " " + long_ + " x " + long_,
             "line": clean + " " + " ".join(clean.split()[:8]), "half": clean + " " + short, "same": "word " * 400}
    docs = spark.createDataFrame(list(texts.items()), "name string, text string").withColumn("n_words", F.lit("clash")).withColumn("spans", F.lit(1))
    kept = {r.name: (r.kept, r.base_failed) for r in quality_rules.quality(docs, ["name"]).collect()}
    assert {name for name, (good, _) in kept.items() if good} == {"clean", "line"}
    assert {name for name, (_, failed) in kept.items() if failed} == {"short", "null", "empty", "copy", "passage", "same"}
    left = quality_rules.drop_low_quality(docs.union(docs))
    assert left.columns == docs.columns
    assert sorted(r.name for r in left.collect()) == ["clean", "clean", "line", "line"]
    assert quality_rules.quality(docs.limit(0), ["name"]).count() == 0


def test_quality_query(spark):
    known = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    for r in QUERIES["op13_quality_rules"](spark, SF_DIR).collect():
        if len(known[r.doc_id] or "") < 3000:
            wanted, _ = plain_quality(known[r.doc_id], quality_rules.MIN_REPEAT)
            assert {k: r[k] for k in wanted} == wanted
            assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
            assert not (r.base_failed and r.kept)


def test_search_query_at_a_hundredth(spark):
    sf_dir = "/root/testdata/sf0.01"
    assert compare.difference(QUERIES["op12_lexical_search"](spark, sf_dir), compare.connect(sf_dir), lexical_search.OP12_SQL) is None
