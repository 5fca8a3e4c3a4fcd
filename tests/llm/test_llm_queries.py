"""Queries of the document operators: against DuckDB where SQL expresses them, else their contract."""

import hashlib
import zlib

import compare
import public_tokenizers as tokenizers
import pytest

from fleetframe.llm.queries import QUERIES, SQL

SF_DIR = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_minhash": ["doc_id", "n_shingles", "component_id", "kept"],
    "op2_url_filter": ["page_id", "host", "path", "rule", "verdict"],
    "op3_toxicity": ["doc_id", "held_out", "score", "predicted", "n_terms"],
    "op4_embedding_dedup": ["vec_id", "n_links", "component_id", "kept"],
    "op5_decontaminate": ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
    "op6_token_counts": ["doc_id", "n_bytes", "n_tokens", "over_limit", "n_chars_within"],
    "op7_byte_bpe": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    "op8_secret_scan": ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
    "op9_line_dedup": ["doc_id", "n_lines", "n_dropped", "n_chars_kept", "kept_sha256"],
    "op10_language_id": ["doc_id", "held_out", "lang_pred", "score"],
    "op11_token_alignment": ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"],
    "op12_lexical_search": ["item_id", "rank", "doc_id", "score"],
    "op13_quality_rules": ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
                           "n_covered", "longest_repeat"],
}
NATIVE = {"op5_decontaminate"}


def test_registered():
    assert set(QUERIES) == set(COLUMNS)


@pytest.mark.parametrize("name", sorted(SQL))
def test_against_duckdb(spark, name):
    assert compare.difference(QUERIES[name](spark, SF_DIR), compare.connect(SF_DIR), SQL[name]) is None


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns_and_rows(spark, name):
    made = QUERIES[name](spark, SF_DIR)
    assert made.columns == COLUMNS[name]
    if name == "op12_lexical_search":
        return
    table = {"op2_url_filter": "pages", "op4_embedding_dedup": "embeddings"}.get(name, "documents")
    assert made.count() == spark.read.parquet(f"{SF_DIR}/{table}.parquet").count()


@pytest.mark.parametrize("name", sorted(NATIVE))
def test_native_plan(spark, name):
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert not [x for x in ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoopJoin") if x in plan]


def texts(spark):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()}


def test_byte_bpe_as_the_library(spark):
    import tiktoken

    from fleetframe.llm.byte_bpe import load_ranks

    library = tiktoken.Encoding("own", pat_str=tokenizers.PATTERN, special_tokens={},
                                mergeable_ranks=load_ranks(tokenizers.path("byte_bpe_multi_50k.tiktoken")))
    known = texts(spark)
    for r in QUERIES["op7_byte_bpe"](spark, SF_DIR).collect():
        ids = library.encode_ordinary(known[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in ids)).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(known[r.doc_id].encode()).hexdigest()


def test_token_counts_as_the_library(spark):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=tokenizers.path("piece_bpe_32k.model"))
    known = texts(spark)
    for r in QUERIES["op6_token_counts"](spark, SF_DIR).collect():
        n = len(library.encode(known[r.doc_id]))
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(known[r.doc_id].encode()), n, n > 4096)


@pytest.mark.parametrize(("name", "folds", "number"), [("op3_toxicity", 5, 0), ("op10_language_id", 4, 2)])
def test_folds(spark, name, folds, number):
    for r in QUERIES[name](spark, SF_DIR).collect():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % folds == number)
        assert 0.0 <= r.score <= 1.0


def test_language_accuracy(spark):
    known = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    held = [(r.lang_pred, known[r.doc_id]) for r in QUERIES["op10_language_id"](spark, SF_DIR).collect() if r.held_out]
    assert held and sum(a == b for a, b in held) / len(held) > 0.95


def test_toxicity_accuracy(spark):
    sf_dir = "/root/testdata/sf0.1"
    known = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    held = [(r.predicted, known[r.doc_id]) for r in QUERIES["op3_toxicity"](spark, sf_dir).collect()
            if r.held_out and r.doc_id in known]
    assert sum(a == b for a, b in held) / len(held) > 0.97
    assert sum(a and not b for a, b in held) <= 0.01 * len(held)
