"""Periodic runs, the trie of conversations and repeated passages against brute force and SQL."""

import hashlib
import random
import re
import zlib
from collections import defaultdict
from fractions import Fraction

import duckdb
import numpy as np
import pytest

from ledgerfold.llm import periodic_runs, prefix_trie, suffix_trees

DOCS = "doc_id bigint, text string"


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def all_runs(w, shortest=24, repeats=3):
    """Runs by trying every period at every place."""
    n, found = len(w), {}
    for q in range(1, n // repeats + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and w[j] == w[j + q]:
                j += 1
            if j - i + q >= max(shortest, repeats * q) and j > i:
                found.setdefault((i, j - i + q), q)
            i = j + 1
    return sorted((s, m, q) for (s, m), q in found.items())


def looping(rng, n, alphabet):
    """Words with stretches that go in circles, which may touch, overlap or nest."""
    w = [rng.randrange(alphabet) for _ in range(n)]
    for _ in range(rng.randint(0, 3) if n > 20 else 0):
        p, a, m = rng.randint(1, 12), rng.randrange(n), rng.randint(10, 80)
        unit = [rng.randrange(50) for _ in range(p)]
        w[a : a + m] = [unit[i % p] for i in range(m)][: n - a]
    return w


@pytest.mark.parametrize("shortest, repeats", [(24, 3), (4, 2), (10, 3)])
def test_runs_of_many_texts(shortest, repeats):
    rng = random.Random(shortest)
    for _ in range(60):
        texts = [
            looping(rng, rng.choice([0, 1, 5, 30, 80, 200]), rng.choice([1, 2, 3, 20]))
            for _ in range(rng.randint(0, 8))
        ]
        words = np.array([x for t in texts for x in t], np.int64)
        n = np.array([len(t) for t in texts], np.int64)
        got = periodic_runs.runs_of(words, n, shortest, repeats).tolist()
        want = [[d, *r] for d, t in enumerate(texts) for r in all_runs(t, shortest, repeats)]
        assert sorted(got) == sorted(want)


def test_extensions_are_exact():
    rng = random.Random(5)
    words = looping(rng, 300, 2)
    symbols = np.array([0, *[x + 2 for x in words], 1], np.int64)
    grammar = periodic_runs.recompressed(symbols.copy(), 2)
    pairs = [(i, j) for i in range(1, 301) for j in range(i + 1, 301)]
    p, q = np.array(pairs).T
    ahead, behind = grammar.extension(p, q, 1), grammar.extension(p, q, -1)
    for i, j, a, b in zip(p, q, ahead, behind, strict=True):
        assert a == next(k for k in range(302) if symbols[i + k] != symbols[j + k])
        assert b == next(k for k in range(302) if symbols[i - k] != symbols[j - k])


def test_runs_report(spark):
    rng = random.Random(2)
    rows = [(i, " \n".join(f"w{x}" for x in looping(rng, rng.randint(0, 250), 30))) for i in range(150)]
    rows += [(200, None), (201, ""), (202, "a " * 1000), (203, "a b " * 500 + "c " * 40), (None, "x y " * 30)]
    docs = spark.createDataFrame(rows, DOCS).repartition(4)
    got = {r.doc_id: tuple(r)[1:] for r in periodic_runs.runs_report(docs).collect()}
    assert len(got) == len(rows)
    for i, text in rows:
        w = words_of(text)
        n, h = len(w), zlib.crc32(str(i).encode())
        g = h // 10
        if i is not None and h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = w[:a] + [w[a + (k - a) % p] for k in range(a, n)]
        runs = all_runs(w)
        dropped = {k for s, m, q in runs for k in range(s + q, s + m)}
        best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None,) * 3)
        lines = "".join(f"{s},{m},{q}\n" for s, m, q in sorted(runs, key=lambda r: (r[0], r[2])))
        milli = 1000 * best[1] // best[2] if runs else None
        left = " ".join(x for k, x in enumerate(w) if k not in dropped)
        assert got[i] == (len(runs), *best, milli, sha(lines), sha(left))


def trie_by_hand(turns):
    """Nodes by listing every first sequence of every rebuilt conversation."""
    own = defaultdict(list)
    for conv, no, role, text in turns:
        role, text = role or "", text or ""
        tie = sha(f"{len(role.encode())}:{role}{text}")
        own[conv].append((no is not None, no or 0, tie, role, text))
    own = {c: [t[3:] for t in sorted(rows)] for c, rows in own.items()}
    members = defaultdict(list)
    for c, rows in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        whole = own.get(c - c % 5, [])[:h] + rows[h:]
        for d in range(len(whole) + 1):
            members[tuple(whole[:d])].append((c, d == len(whole)))
    saved = {k: (len(m) - 1) * len(k[-1][1].encode()) if k else 0 for k, m in members.items()}
    inner = {k[:-1] for k in members if k}
    made = []
    for node, who in members.items():
        under = [k for k in members if k[: len(node)] == node]
        made.append(
            (
                min(c for c, _ in who),
                len(node),
                min(c for c, _ in members[node[:-1]]) if node else None,
                len(who),
                sum(len(k) == len(node) + 1 for k in under),
                sum(k not in inner for k in under),
                sum(saved[k] for k in under),
                sha(",".join(str(c) for c in sorted(c for c, end in who if end))),
            )
        )
    return sorted(made, key=repr)


def conversations(rng, convs):
    """Many share first turns; some go deep, one far more often than others."""
    rows = []
    for c in convs:
        for t in range(rng.choice([1, 2, 3, 5, 9, 14])):
            rows.append((c, None if rng.random() < 0.05 else t, rng.choice(["user", "bot"]) if t > 2 else "user",
                         f"common {t}" if rng.random() < 0.7 else f"té {rng.randrange(4)}"))
    return rows


@pytest.mark.parametrize("shares", [256, 3])
def test_trie_equals_a_plain_listing(spark, monkeypatch, shares):
    monkeypatch.setattr(prefix_trie, "SHARES", shares)
    rng = random.Random(shares)
    rows = conversations(rng, rng.sample(range(400), 150))
    rows += [(1000, t, "user", f"deep {t % 3}") for t in range(600)]
    rows += [(c, t, "user", f"same {t}") for c in range(500, 560) for t in range(12)]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    got = prefix_trie.trie_report(turns.repartition(5)).collect()
    assert sorted((tuple(r) for r in got), key=repr) == trie_by_hand(rows)


def test_a_queue_spills_and_stays_in_order():
    rng = random.Random(3)
    queue, plain, out = prefix_trie.SpillingQueue(most=10), [], []
    for _ in range(2000):
        if plain and rng.random() < 0.45:
            assert queue.head() == min(plain)
            plain.remove(min(plain))
            out.append(queue.pop())
        else:
            item = ((rng.randrange(50), rng.randrange(5)), rng.randrange(100))
            queue.push(item)
            plain.append(item)
    while plain:
        assert queue.pop() == min(plain)
        plain.remove(min(plain))
    assert queue.head() is None


def removed_by_hand(rows, size=13):
    least = {}
    for i, text in rows:
        w = words_of(text)
        for k in range(len(w) - size + 1) if i is not None else ():
            gram = tuple(w[k : k + size])
            least[gram] = min(i, least.get(gram, i))
    made = []
    for i, text in rows:
        w = words_of(text)
        gone = {
            k + j
            for k in range(len(w) - size + 1)
            if i is not None and least[tuple(w[k : k + size])] < i
            for j in range(size)
        }
        made.append((i, len(w), len(gone), sha(" ".join(x for k, x in enumerate(w) if k not in gone))))
    return sorted(made, key=repr)


def passages(rng):
    base = [[f"p{rng.randrange(300)}" for _ in range(rng.randint(10, 60))] for _ in range(12)]
    rows = []
    for i in range(120):
        parts = []
        for _ in range(rng.randint(0, 5)):
            piece = list(rng.choice(base)) if rng.random() < 0.5 else [f"f{rng.randrange(9)}" for _ in range(20)]
            if rng.random() < 0.3 and piece:
                piece[rng.randrange(len(piece))] = "changed"
            parts += piece[rng.randrange(3) :]
        rows.append((i % 100, rng.choice([" ", "\n", " \t"]).join(parts)))
    rows += [(300 + k, "the same passage of words again and again " * 20) for k in range(40)]
    rows += [(None, "the same passage of words again and again " * 3), (400, None), (401, ""), (3, "ü ß " * 30)]
    rows += [(402, " ".join(["one"] * 500)), (403, " ".join(["one"] * 40)), (403, " ".join(["one"] * 40))]
    return rows


@pytest.mark.parametrize("groups", [None, 1, 9])
def test_repeated_passages(spark, monkeypatch, groups):
    rows = passages(random.Random(11))
    docs = spark.createDataFrame(rows, DOCS).repartition(5)
    monkeypatch.setattr(suffix_trees, "_SPLIT", 5000)
    got = suffix_trees.without_repeats(docs, groups).collect()
    made = sorted(((r.doc_id, r.n_words, r.n_removed, sha(r.kept)) for r in got), key=repr)
    assert made == removed_by_hand(rows)


def test_frequent_prefixes_grow(spark):
    """With a word that starts most suffixes, groups follow longer prefixes and rows stay right."""
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice(["the", "the", "the", f"x{rng.randrange(30)}"]) for _ in range(200))) for i in range(60)]
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    got = suffix_trees.without_repeats(docs, 20).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, sha(r.kept)) for r in got), key=repr) == removed_by_hand(rows)


def test_queries_equal_sql(spark, sf_dir):
    import __spark_entry__ as se

    connection = duckdb.connect()
    for table in ("documents", "conversations"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    for name in ("op12_prefix_trie", "op13_suffix_trees"):
        got = se.queries()[name](spark, sf_dir)
        want = connection.execute(se.oracle_sql()[name])
        assert [d[0] for d in want.description] == got.columns
        rows = sorted(want.fetchall(), key=repr)
        assert rows and sorted((tuple(r) for r in got.collect()), key=repr) == rows
