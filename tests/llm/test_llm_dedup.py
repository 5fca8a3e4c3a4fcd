"""Near duplicates of texts and vectors, and components, against brute force."""

import random
import sys

import numpy as np
import pytest

from fleetframe.llm import common, embedding_dedup, minhash
from fleetframe.llm.components import components


def roots(nodes, edges):
    parent = {n: n for n in nodes}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    made = random.Random(1)
    edges = [(i, i + 1) for i in range(40)] + [(100, n) for n in range(101, 160)] + [
        (made.randint(200, 400), made.randint(200, 400)) for _ in range(150)] + [(500, 500)]
    found = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    edges = [e for e in edges if e[0] != e[1]]  # a node with no other neighbour is not listed
    assert found == roots({n for e in edges for n in e}, edges)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.fixture
def many_partitions(spark):
    """As on a session that never joins small shuffle partitions."""
    settings = {"spark.sql.shuffle.partitions": "48", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.fixture
def steps(monkeypatch):
    """Partitions that the written steps of `components` have."""
    module, seen = sys.modules[components.__module__], []

    def written(df, name):
        seen.append(df.rdd.getNumPartitions())
        return common.staged(df, name)

    monkeypatch.setattr(module, "staged", written)
    return seen


def test_small_components_in_few_tasks(spark, many_partitions, steps):
    edges = [(n, n + 1) for n in range(60)] + [(100, n) for n in range(101, 400)]
    frame = spark.createDataFrame(edges, "a long, b long").coalesce(2)
    found = {r.node: r.component for r in components(frame).collect()}
    assert found == roots({n for e in edges for n in e}, edges)
    assert len(steps) > 3 and max(steps) <= common.SMALL_PARTS


def test_stars_need_no_step(spark, steps):
    edges = [(100, n) for n in range(101, 160)] + [(7, 8), (20, 9)]
    found = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == roots({n for e in edges for n in e}, edges)
    assert len(steps) == 1


@pytest.mark.parametrize("size", [0, 1024 * 1024])
def test_components_of_large_tables(spark, monkeypatch, steps, size):
    """Plans for small and for large tables agree, with repeated and reversed edges."""
    monkeypatch.setattr(common, "SMALL_BYTES", size)
    made = random.Random(2)
    edges = [(made.randint(0, 300), made.randint(0, 300)) for _ in range(220)]
    edges += [(b, a) for a, b in edges[:50]] + edges[:50]
    found = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    edges = [e for e in edges if e[0] != e[1]]
    assert found == roots({n for e in edges for n in e}, edges)


def shingle_sets(texts):
    sets = {}
    for i, t in texts:
        words = (t or "").encode().lower().split()
        sets[i] = frozenset(tuple(words[k:k + 5]) for k in range(max(1, len(words) - 4))) if words else frozenset()
    return sets


def expected_components(sets):
    ids = [i for i in sets if i is not None]
    edges = [(a, b) for a in ids for b in ids if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    return roots(ids, edges)


def corpus():
    """Near copies of a base, a passage that many texts share, exact copies, short and empty texts."""
    made = random.Random(9)

    def words(n):
        return ["".join(made.choices("abcdefgh", k=5)) for _ in range(n)]

    base, passage, texts = words(120), words(60), []
    for _ in range(40):  # changed at some places: many lie just above or below the threshold
        own = list(base)
        for at in made.sample(range(120), made.randint(1, 6)):
            own[at] = made.choice("xyz") * 3
        texts.append(" ".join(own))
    texts += [" ".join(words(k) + passage + words(k)) for k in (4, 8, 12, 16, 20) for _ in range(8)]
    texts += [texts[3]] * 4 + [" ".join(base).upper() + "\t\n"] * 2
    texts += [None, "", "  ", "one", "One", "one two", "a b c d", "a b c d e", "a  b c d"]
    made.shuffle(texts)
    return list(enumerate(texts))


def test_near_duplicate_texts(spark):
    texts = corpus()
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    sets = shingle_sets(texts)
    expected = expected_components(sets)
    found = {r.doc_id: r for r in minhash.near_duplicates(docs).collect()}
    assert {i: r.component_id for i, r in found.items()} == expected
    assert all(r.n_shingles == len(sets[i]) and r.kept == (i == expected[i]) for i, r in found.items())
    kept = minhash.keep_one(docs.withColumnRenamed("text", "body").selectExpr("doc_id", "body", "1 AS `_gone`"), text="body")
    assert kept.columns == ["doc_id", "body", "_gone"]
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i in expected if expected[i] == i)


def test_hubs_alone_would_not_do(spark, monkeypatch):
    """Even with no second hub the prefix join finds what the first hub missed."""
    monkeypatch.setattr(minhash, "ROUNDS", 1)
    texts = corpus()
    found = {r.doc_id: r.component_id for r in minhash.near_duplicates(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    assert found == expected_components(shingle_sets(texts))


def test_repeated_and_null_ids(spark):
    texts = [(1, "p q r s t u v"), (1, "a b c d e f g"), (2, "a b c d e f g"), (3, "p q r s t u v"), (None, "a b c d e f g"), (3, "p q r s t u v")]
    found = minhash.near_duplicates(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.component_id, r.kept) for r in found if r.doc_id) == [
        (1, 1, True), (1, 1, True), (2, 1, False), (3, 1, False), (3, 1, False)]
    assert [(r.component_id, r.kept) for r in found if r.doc_id is None] == [(None, True)]
    assert minhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_near_copies_under_one_id(spark):
    """Of an id with a short and a long version of a text, each version links with what is like it."""
    words = [f"w{i}" for i in range(60)]
    rows = [(1, " ".join(words[:45])), (1, " ".join(words)), (2, " ".join(words[:36])), (3, " ".join([*words, *"abcdefghijklmnop"])), (4, "quite another text of its own")]
    found = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in found} == {1: 1, 2: 1, 3: 1, 4: 4}


def test_text_ids_and_least_ids(spark):
    texts = corpus()
    named = [(f"d{i:04d}", t) for i, t in texts]
    expected = expected_components(shingle_sets(texts))
    found = {r.doc_id: r.component_id for r in minhash.near_duplicates(spark.createDataFrame(named, "doc_id string, text string")).collect()}
    assert found == {f"d{i:04d}": f"d{c:04d}" for i, c in expected.items()}
    least = -2**63
    rows = [(least, "p q r s t u v"), (5, "p q r s t u v"), (7, "p q r s t u v w x y z a b c d e f g h i j k"), (9, "p q r s t u v w x y z a b c d e f g h i j k l")]
    found = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in found} == {least: least, 5: least, 7: 7, 9: 7}


def test_staged_tables_go(spark):
    """What near-dedup staged for its links is deleted when they stand; all of it on release."""
    from pathlib import Path

    from fleetframe.llm import common
    from fleetframe.session import work_path

    root = Path(work_path(spark, "x").removeprefix("file:")).parent
    common.release(spark)
    known = set(root.iterdir())
    found = minhash.near_duplicates(spark.createDataFrame(corpus(), "doc_id long, text string"))
    left = sorted(p.name.rsplit("-", 1)[0] for p in set(root.iterdir()) - known)
    assert left == ["classes", "components", "signatures", "spanning-links"]
    assert found.count() == len(corpus())
    common.release(spark)
    assert set(root.iterdir()) == known


def test_vectors_of_extreme_size(spark):
    """The links of tiny and of huge vectors are those of the same vectors at ordinary size; ids may be text."""
    made = np.random.default_rng(11)
    first = made.standard_normal((40, 8))
    near = first[:20] + 0.12 * made.standard_normal((20, 8))
    vectors = np.concatenate([first, near])

    def links(factor):
        rows = [(f"v{i:03d}", (v * factor).tolist()) for i, v in enumerate(vectors)]
        found = embedding_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id string, embedding array<double>"))
        return {r.vec_id: (r.n_links, r.component_id) for r in found.collect()}

    plain = links(1.0)
    assert sum(n for n, _ in plain.values()) > 10
    assert links(2.0**-700) == links(2.0**600) == plain


@pytest.mark.parametrize("dims", [3, 48])
def test_near_duplicate_vectors(spark, dims):
    made = np.random.default_rng(3)
    base = made.standard_normal((60, dims))
    vectors = np.concatenate([base, base[:20] + 0.35 / np.sqrt(dims) * np.linalg.norm(base[:20], axis=1, keepdims=True) * made.standard_normal((20, dims)),
                              base[:5], base[:3] * 2.5])
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    odd = [(900, None), (901, []), (902, [0.0] * dims), (903, [float("nan")] * dims), (904, [None] * dims), (905, [float("inf")] * dims),
           (906, [1.0] * (dims + 1)), (None, rows[0][1])]
    found = embedding_dedup.near_duplicates(spark.createDataFrame([*rows, *odd], "vec_id long, embedding array<double>")).collect()
    units = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    near = (units @ units.T >= 0.9) & ~np.eye(len(vectors), dtype=bool)
    edges = [(int(a), int(b)) for a, b in zip(*np.nonzero(near), strict=True)]
    expected = roots(range(len(vectors)), edges)
    by = {r.vec_id: r for r in found}
    total = sum(by[i].n_links for i in range(len(vectors)))
    assert 0.98 * near.sum() <= total <= near.sum()
    if total == near.sum():
        assert all(by[i].component_id == expected[i] and by[i].kept == (i == expected[i]) for i in range(len(vectors)))
    assert all(by[i].n_links == 0 and by[i].component_id == i and by[i].kept for i in range(900, 907))
    assert by[None].component_id is None and by[None].kept and by[None].n_links == 0


def test_no_vectors(spark):
    assert embedding_dedup.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_filters_are_all_that_reach_the_threshold():
    own = embedding_dedup.CapFilters(16, (0.55, 2, 40), 0)
    made = np.random.default_rng(8).standard_normal((5, 16))
    units = made / np.linalg.norm(made, axis=1, keepdims=True)
    rotated = own._rotate(units).reshape(5, own.blocks, -1)
    for vector, found in zip(rotated, own.decode(units), strict=True):
        sums = np.zeros(1)
        for block in range(own.blocks):
            sums = (sums[:, None] + own.code[block] @ vector[block]).ravel()
        assert found.tolist() == np.flatnonzero(sums >= min(own.threshold, sums.max() - 1e-12)).tolist()


def test_recall_at_the_cosine(spark):
    made = np.random.default_rng(5)
    first = made.standard_normal((1500, 64))
    first /= np.linalg.norm(first, axis=1, keepdims=True)
    other = made.standard_normal((1500, 64))
    other -= (other * first).sum(axis=1, keepdims=True) * first
    other /= np.linalg.norm(other, axis=1, keepdims=True)
    second = 0.9005 * first + np.sqrt(1 - 0.9005**2) * other
    rows = [(i, v.tolist()) for i, v in enumerate(np.concatenate([first, second]))]
    found = embedding_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    assert found.where("n_links > 0").count() >= 0.99 * 3000
