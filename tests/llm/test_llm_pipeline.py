"""The corpus pipeline: each stage on its own input, and planted cases through all of them."""

import random

import corpus_pipeline
import public_tokenizers as tokenizers


def test_pipeline(spark, tmp_path):
    made = random.Random(6)

    def words(n):
        return " ".join("".join(made.choices("abcdefghij", k=5)) for _ in range(n))

    item = words(14)
    texts = [words(40) for _ in range(300)]
    texts = [f"{t} {'vile' if i % 10 == 0 else ''}" for i, t in enumerate(texts)]
    texts = [f"site menu\n{t}" if i % 3 == 0 else t for i, t in enumerate(texts)]
    texts += [texts[1], texts[2] + " tail", f"{words(30)} {item} {words(30)}", None, ""]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    sf_dir = str(tmp_path)
    docs.write.parquet(f"{sf_dir}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{sf_dir}/benchmark.parquet")
    spark.createDataFrame([(i, int(i % 10 == 0)) for i in range(300)], "doc_id long, toxic int").write.parquet(f"{sf_dir}/labels.parquet")

    seen, now = [], docs
    for name, stage in corpus_pipeline.STAGES:
        made_by = stage(spark, now, sf_dir)
        made_by.write.parquet(f"{sf_dir}/{len(seen)}")
        if name != "encoding":
            assert made_by.columns == docs.columns
        now = spark.read.parquet(f"{sf_dir}/{len(seen)}")
        seen.append({r.doc_id: r for r in now.collect()})
    toxic, lines, unique, clean, encoded = seen
    assert set(toxic) == {i for i in range(305) if i >= 300 or i % 10}
    assert set(lines) == set(toxic)
    assert lines[3].text == texts[3].split("\n")[1] and lines[3].n_chars == len(lines[3].text) and lines[303].text is None
    assert set(toxic) - set(unique) == {300, 301}
    assert set(unique) - set(clean) == {302}
    assert set(encoded) == set(clean) and all(r.exact for r in encoded.values())
    from fleetframe.llm.byte_bpe import load_ranks

    token = {i: t for t, i in load_ranks(tokenizers.path("byte_bpe_multi_50k.tiktoken")).items()}
    assert all(b"".join(token[i] for i in r.ids).decode() == (clean[d].text or "") for d, r in encoded.items())
    assert {r.doc_id for r in corpus_pipeline.run(spark, sf_dir).select("doc_id").collect()} == set(encoded)


def test_copies_of_a_text_keep_its_lines(spark):
    """A third of a source is one text: line dedup leaves it whole, near-dedup keeps it once."""
    made = random.Random(8)

    def words(n):
        return " ".join("".join(made.choices("abcdefghij", k=5)) for _ in range(n))

    copied = "\n".join(words(12) for _ in range(4))
    texts = [copied] * 30 + [f"site menu\n{words(40)}" for _ in range(60)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    cut = corpus_pipeline.drop_lines(spark, docs, "").localCheckpoint()
    assert {r.text for r in cut.where("doc_id < 30").collect()} == {copied}
    assert all(r.text == texts[r.doc_id].split("\n")[1] for r in cut.where("doc_id >= 30").collect())
    kept = {r.doc_id: r.text for r in corpus_pipeline.keep_one_copy(spark, cut, "").collect()}
    assert sorted(kept) == [0, *range(30, 90)] and kept[0] == copied


def test_passages_over_sources(spark):
    """Long lines go from two different texts of a source on, at any size; near copies are one text."""
    made = random.Random(9)

    def words(n):
        return " ".join("".join(made.choices("abcdefghij", k=5)) for _ in range(n))

    passage, single, copied = words(60), words(60), [words(30) for _ in range(8)]
    texts = [(f"s{i % 2}", f"{words(80)}\n{passage}\n{words(90)}") for i in range(6)]
    texts += [(f"s{i}", f"{words(80)}\n{single}") for i in range(3)]
    texts += [("s0", "\n".join([*copied, words(3)])) for _ in range(5)]
    texts += [("few", f"head line\n{words(40)}") for _ in range(4)]
    texts += [("s0", words(100)) for _ in range(700)]
    docs = spark.createDataFrame([(i, t, "en", s, len(t)) for i, (s, t) in enumerate(texts)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    found = {r.doc_id: r.text for r in corpus_pipeline.drop_lines(spark, docs, "").collect()}
    for i, (_, text) in enumerate(texts):
        gone = passage if i < 6 else "head line" if 14 <= i < 18 else None
        assert found[i] == "\n".join(x for x in text.split("\n") if x != gone), i


def test_entry_points():
    import __spark_entry__

    assert __spark_entry__.queries()["pipeline"] is corpus_pipeline.run
    assert 4 <= len(corpus_pipeline.STAGES) <= 5 and corpus_pipeline.ORACLE_SQL is None
