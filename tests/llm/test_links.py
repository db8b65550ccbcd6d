"""Similarity joins and mixing against brute force and SQL."""

import random
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from ledgerfold.llm import dart_minhash, epsilon_join, graph, mixing


def grams(text):
    words = text.split()
    return Counter(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else Counter()


def jaccard(a, b):
    common = sum((a & b).values())
    return common / max(1, sum(a.values()) + sum(b.values()) - common)


def classes(texts):
    """Class of each text by all pairs: the smallest index it reaches."""
    sets = [grams(t) for t in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if texts[i] == texts[j] and sets[i] or jaccard(sets[i], sets[j]) >= 0.8:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(texts))]


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"e{rng.randrange(10**9)}"
    return " ".join(words)


@pytest.fixture(scope="module")
def copies():
    """Groups of copies that drift apart, repeats within texts, and unlike texts."""
    rng, texts = random.Random(8), []
    for _ in range(6):
        base = [f"w{rng.randrange(5000)}" for _ in range(rng.randint(30, 200))]
        texts += [edited(rng, base, rng.randint(0, 6)) for _ in range(25)]
        texts += [" ".join(base * 3), " ".join(base * 4)]
    chain = [f"c{i}" for i in range(100)]
    texts += [" ".join([f"x{i}" for i in range(k)] + chain[k:]) for k in range(0, 40, 3)]
    return texts + ["one two", "one two", "", "a", "a b c d", "a b c d e"]


def test_signatures_estimate_similarity(copies):
    owner, value, weight = dart_minhash.shingles(copies)
    made = dart_minhash.signatures(len(copies), owner, value, weight, 1024)
    rng = random.Random(1)
    errors = []
    for _ in range(300):
        i, j = rng.randrange(len(copies)), rng.randrange(len(copies))
        if copies[i] and copies[j]:
            errors.append((made[i] == made[j]).mean() - jaccard(grams(copies[i]), grams(copies[j])))
    assert np.abs(errors).max() < 0.08 and abs(np.mean(errors)) < 0.01


def test_linked_compares_all_pairs(copies):
    owner, value, weight = dart_minhash.shingles(copies[:160])
    cut = np.searchsorted(owner, np.arange(161))
    profiles = [(value[a:b], weight[a:b]) for a, b in zip(cut, cut[1:], strict=False)]
    assert dart_minhash.linked(profiles, 0.8).tolist() == classes(copies[:160])


@pytest.mark.parametrize("members", [1024, 7])
def test_classes(spark, copies, members, monkeypatch):
    monkeypatch.setattr(dart_minhash, "MEMBERS", members)
    order = list(range(len(copies)))
    random.Random(2).shuffle(order)
    docs = spark.createDataFrame([(i, copies[i]) for i in order], "doc_id long, text string")
    got = {r.doc_id: r.class_id for r in dart_minhash.near_duplicates(docs.repartition(5)).collect()}
    assert [got[i] for i in range(len(copies))] == classes(copies)


def test_components(spark):
    rng = random.Random(6)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)]
    edges += [(1000 + i, 1001 + i) for i in range(200)] + [(5, 5)]
    root = {n: n for e in edges for n in e}
    for _ in range(len(root)):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    alone = {n for n in root if all(a == b for a, b in edges if n in (a, b))}
    got = graph.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.label for r in got} == {n: v for n, v in root.items() if n not in alone}


@pytest.mark.parametrize("block", [4096, 40])
def test_vectors(spark, block, monkeypatch):
    monkeypatch.setattr(epsilon_join, "SMALL", 8)
    monkeypatch.setattr(epsilon_join, "BLOCK", block)
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(12, 16))
    x = (centres[rng.integers(0, 12, 700)] + rng.normal(size=(700, 16)) * 0.33).astype(np.float32)
    x[50:80] = x[50]
    rows = [(i, [float(v) for v in x[i]]) for i in range(len(x))]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(6)
    got = {r.vec_id: r for r in epsilon_join.linked_vectors(vectors).collect()}
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    near = u @ u.T >= 0.9
    root = np.arange(len(x))
    for _ in range(len(x)):
        after = np.where(near, root, len(x)).min(axis=1)
        if (after == root).all():
            break
        root = after
    for i, r in got.items():
        assert (r.n_links, r.component_id) == (near[i].sum() - 1, root[i])


def _mixed_in_sql(rows):
    con = duckdb.connect()
    con.sql("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", rows)
    return sorted(con.sql(mixing.mixing_sql()).fetchall(), key=repr)


@pytest.fixture(scope="module")
def sources():
    rng = random.Random(7)
    rows = [(i, "w " * rng.randint(0, 40), f"s{min(3, i % 9)}") for i in range(400)]
    return rows + [(400, None, "s0"), (401, "a b", None), (None, "c d e", "s1"), (403, "", "void")]


def test_mixing_is_as_in_sql(spark, sources):
    docs = spark.createDataFrame(sources, "doc_id long, text string, source string").repartition(4)
    got = sorted(map(tuple, mixing.mixing_report(docs).collect()), key=repr)
    assert got == _mixed_in_sql(sources)


def test_mixing_of_copies_is_as_in_sql(spark, sources):
    # rows of one id, of none, and copies of one row, each many enough to hold the end of a budget
    rows = sources + [(9, "x y z", "s0")] * 700 + [(None, f"q {'r ' * (i % 5)}", "s3") for i in range(300)]
    rows += [(8, "u v", "s2")] * 90 + [(8, None, "s2")] * 30
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    got = sorted(map(tuple, mixing.mixing_report(docs).collect()), key=repr)
    assert got == _mixed_in_sql(rows)


def test_repetitions_and_budget(spark, sources):
    docs = spark.createDataFrame(sources, "doc_id long, text string, source string")
    size, drawn = Counter(), Counter()
    for _, text, source in sources:
        size[source] += len((text or "").split())
    for r in mixing.mixed(docs, repetitions=1.5).collect():
        drawn[r.source] += r.tokens
    assert all(size[s] <= drawn[s] <= 1.5 * size[s] + 1e-6 for s in size)
    spent = sum(r.tokens for r in mixing.mixed(docs, repetitions=4, budget=2000).collect())
    assert 1700 <= spent <= 2000


def test_entropy(spark, sources):
    docs = spark.createDataFrame(sources, "doc_id long, text string, source string")
    rows = mixing.sized(docs, "mix").groupBy("source").sum("tokens").toDF("source", "total").cache()
    a = mixing.exponent(rows, None, 0.9, None)
    p = np.array([r.total for r in rows.collect() if r.total], float)
    w = (p / p.sum()) ** a
    w /= w.sum()
    assert 0 < a < 1 and abs(-(w * np.log(w)).sum() / np.log(len(w)) - 0.9) < 1e-4
    with pytest.raises(ValueError, match="either"):
        mixing.mixed(docs, repetitions=2, entropy=0.5)


def test_close_vectors_take_little_memory():
    """Two full blocks whose vectors are all close: no list of all pairs is made."""
    import tracemalloc

    rng = np.random.default_rng(3)
    n = 2 * epsilon_join.BLOCK
    vectors = np.array([1.0, 0, 0, 0, 0, 0, 0, 0]) + rng.normal(0, 0.01, (n, 8))
    ids = pa.array(np.arange(n))
    node = pa.StructArray.from_arrays(
        [pa.array(np.zeros(n, bool)), ids, pa.array([str(i).encode() for i in range(n)])], ["no_id", "id", "digest"]
    )
    offsets = pa.array(np.arange(n + 1, dtype=np.int32) * 8)
    table = pa.table(
        [pa.array(np.arange(n) // epsilon_join.BLOCK), node, pa.array(np.ones(n, np.int64)),
         pa.ListArray.from_arrays(offsets, pa.array(vectors.reshape(-1)))],
        ["block", "node", "copies", "vector"],
    )
    tracemalloc.start()
    made = epsilon_join._joined((pa.scalar(0), pa.scalar(1)), table, np.eye(8)[:, :6], 0.9)
    assert tracemalloc.get_traced_memory()[1] < 100 << 20
    tracemalloc.stop()
    assert made.column("links").to_pylist() == [epsilon_join.BLOCK] * n
    assert {r["id"] for r in made.column("near").to_pylist()} == {0}
