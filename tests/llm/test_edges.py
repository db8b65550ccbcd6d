"""Nulls, empty and long texts, repeated rows, empty tables and clashing names, for every operator."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from ledgerfold.llm import (
    byte_bpe,
    dart_minhash,
    epsilon_join,
    licenses,
    mixing,
    periodic_runs,
    pii,
    prefix_trie,
    quality_mil,
    quality_rules,
    suffix_trees,
    token_counts,
    toxicity,
)
from ledgerfold.llm.labels import labelled_texts

LONG = "a long text of words that go on " * 20_000
ROWS = [
    (1, "the same text twice with some words in it", "en", "s1", 3),
    (1, "the same text twice with some words in it", "en", "s1", 3),
    (2, None, "en", "s1", None),
    (3, "", None, None, 0),
    (4, " \n\t \n", "en", "s2", 5),
    (None, "a row without an id, mail me@ex.com", "en", "s2", 1),
    (None, "a row without an id, mail me@ex.com", "en", None, 1),
    (5, LONG, "en", "s1", len(LONG)),
    (6, "🙂\x00é ÄÖ", "de", "s3", 6),
    (7, "x" * 200_000, "de", "s3", 200_000),
]
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
# names that operators use for themselves
CLASHES = (
    "row", "digest", "kept", "score", "n_words", "tokens", "pass", "slot", "keys", "node",
    "class_id", "label", "base", "spans", "proposed", "pattern", "quality", "block", "of", "last",
)
LABELS = "doc_id bigint, quality int, toxic int"
BPE = public_tokenizers.PATTERN


def _labels(spark, rows=((1, 1, 0), (1, 1, 0), (5, 0, 1), (6, None, 1), (None, 1, 0), (4, 0, 0))):
    return spark.createDataFrame(list(rows), LABELS)


REPORTS = {
    "quality": lambda s, d: quality_mil.quality_scores(d, _labels(s)),
    "tokens": lambda s, d: token_counts.token_counts(
        d, str(public_tokenizers.path("byte_bpe_50k.json"))
    ),
    "rules": lambda s, d: quality_rules.quality_rules(d),
    "toxicity": lambda s, d: toxicity.toxicity_scores(d, _labels(s)),
    "duplicates": lambda s, d: dart_minhash.near_duplicates(d),
    "licenses": lambda s, d: licenses.license_labels(d),
    "encoding": lambda s, d: byte_bpe.encoded_digests(
        d, str(public_tokenizers.path("byte_bpe_50k.tiktoken")), BPE
    ),
    "pii": lambda s, d: pii.pii_report(d),
    "runs": lambda s, d: periodic_runs.runs_report(d),
    "repeats": lambda s, d: suffix_trees.repeats_report(d),
}
FILTERS = {
    "rules": quality_rules.keep_good,
    "duplicates": dart_minhash.keep_one,
    "pii": pii.redact,
    "mixing": mixing.mix,
}


@pytest.fixture(scope="module")
def docs(spark):
    made = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    from pyspark.sql import functions as F

    return made.withColumns({c: F.lit(f"own {c}") for c in CLASHES}).cache()


@pytest.mark.parametrize("name", REPORTS)
def test_a_report_has_a_row_for_each_document(spark, docs, name):
    made = REPORTS[name](spark, docs)
    got = made.collect()
    assert sorted(map(repr, (r.doc_id for r in got))) == sorted(repr(r[0]) for r in ROWS)
    ones = {tuple(r) for r in got if r.doc_id == 1}
    assert len(ones) == 1
    twins = {tuple(r) for r in got if r.doc_id is None}
    assert len(twins) == 1


@pytest.mark.parametrize("name", REPORTS)
def test_a_report_of_no_rows_is_empty(spark, docs, name):
    made = REPORTS[name](spark, docs.limit(0))
    assert made.collect() == []


@pytest.mark.parametrize("name", REPORTS)
def test_null_reads_as_empty(spark, name):
    pair = spark.createDataFrame([(10, None), (11, "")], "doc_id bigint, text string")
    none, empty = REPORTS[name](spark, pair).orderBy("doc_id").collect()
    own = ("doc_id", "held_out", "class_id")
    assert {k: v for k, v in none.asDict().items() if k not in own} == {
        k: v for k, v in empty.asDict().items() if k not in own
    }


@pytest.mark.parametrize("name", FILTERS)
def test_a_stage_keeps_columns(docs, name):
    made = FILTERS[name](docs)
    assert made.columns == docs.columns
    assert [f.dataType for f in made.schema] == [f.dataType for f in docs.schema]
    for row in made.collect():
        assert row["kept"] == "own kept" and row["row"] == "own row"
    assert FILTERS[name](docs.limit(0)).collect() == []


def test_one_of_repeated_rows_stays(docs):
    left = dart_minhash.keep_one(docs).filter("doc_id = 1").collect()
    assert len(left) == 1


def test_every_row_is_drawn(docs):
    assert mixing.mix(docs).distinct().count() == docs.distinct().count()


def test_models_without_labels(spark, docs):
    few = spark.createDataFrame([], LABELS)
    assert {r.score for r in quality_mil.quality_scores(docs, few).collect()} == {0.5}
    assert {r.score for r in toxicity.toxicity_scores(docs, few).collect()} == {0.5}
    ones = spark.createDataFrame([(1, 1, 1), (5, 1, 1)], LABELS)
    assert min(r.score for r in quality_mil.quality_scores(docs, ones).collect()) > 0.9


def test_a_repeated_id_is_one_training_text(spark, monkeypatch):
    rows = [(1, f"text number {i % 7} of one id") for i in range(50)] + [(2, "another text"), (2, None)]
    labels = _labels(spark, ((1, 1, 1), (2, 0, 0)))
    seen = []

    def fit(given, y):
        seen.append([(x.tolist(), v) for x, v in zip(given, y.tolist(), strict=True)])

    monkeypatch.setattr(quality_mil, "fit", fit)
    for order in (rows, rows[::-1]):
        docs = spark.createDataFrame(order, "doc_id bigint, text string").repartition(5)
        quality_mil.train(docs, labels, 1)
        assert labelled_texts(docs, labels, "toxic", F.lit(True), 1).count() == 2
    assert [sorted(v for _, v in one) for one in seen] == [[0.0, 1.0]] * 2
    assert seen[0] == seen[1]


def test_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0], "x"), (2, [1.0, 0.1], "x"), (2, [1.0, 0.1], "x"), (3, None, "x"),
        (4, [0.0, 0.0], "x"), (5, [nan, 1.0], "x"), (6, [inf, 1.0], "x"), (7, [1.0, None], "x"),
        (8, [0.0, 1.0], "x"), (9, [2.0, 0.0], "x"), (10, [1.0, 0.0, 0.0], "x"), (None, [0.0, 3.0], "x"),
    ]
    vectors = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, node string")
    got = sorted(
        ((r.vec_id or 0, r.n_links, r.component_id, r.kept) for r in epsilon_join.linked_vectors(vectors).collect())
    )
    assert got == [
        (0, 1, 8, False), (1, 3, 1, True), (2, 3, 1, False), (2, 3, 1, False), (3, 0, 3, True),
        (4, 0, 4, True), (5, 0, 5, True), (6, 0, 6, True), (7, 0, 7, True), (8, 1, 8, True),
        (9, 3, 1, False), (10, 0, 10, True),
    ]
    assert epsilon_join.linked_vectors(vectors.limit(0)).collect() == []


def test_vectors_of_several_lengths(spark):
    rows = [(i, [1.0, 0.0, float(i % 2)]) for i in range(6)]
    rows += [(10 + i, [float(i % 2), 1.0]) for i in range(4)] + [(20, [1.0]), (21, [2.0]), (22, [0.0, 0.0, 0.0, 1.0])]
    vectors = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    got = {r.vec_id: (r.n_links, r.component_id) for r in epsilon_join.linked_vectors(vectors).collect()}
    want = {i: (2, i % 2) for i in range(6)} | {10 + i: (1, 10 + i % 2) for i in range(4)}
    assert got == want | {20: (1, 20), 21: (1, 20), 22: (0, 22)}


def test_one_row_of_each_class_stays(spark):
    long = " ".join(f"w{i}" for i in range(200))
    rows = [(None, "copies without an id " + long)] * 4 + [(None, "copies without an id too " + long)]
    rows += [(7, "first text " + "x y z " * 90), (7, "first text of two " + "x y z " * 90), (None, "first text " + "x y z " * 90)]
    rows += [(None, "alone without an id"), (None, ""), (None, ""), (None, None), (8, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    left = [tuple(r) for r in dart_minhash.keep_one(docs).collect()]
    assert sum(t is not None and long in t for _, t in left) == 1
    assert [i for i, t in left if t and t.startswith("first")] == [7]
    assert (None, "alone without an id") in left
    assert left.count((None, "")) == 2 and (None, None) in left and (8, None) in left
    kept = dart_minhash.near_duplicates(docs).filter("kept AND doc_id = 7").collect()
    assert len(kept) == 1


TURNS = "conv_id bigint, turn bigint, role string, text string"


def test_conversations_with_odd_rows(spark):
    rows = [
        (None, 0, "user", "of no conversation"), (0, None, None, None), (0, 0, "user", "x"), (0, 0, "user", "x"),
        (1, 0, "user", None), (1, 1, "user", "y" * 100_000), (2, 0, None, ""), (2, 0, "", None), (3, 9, "a", "b"),
    ]
    turns = spark.createDataFrame(rows, TURNS).withColumns(
        {c: F.lit("own") for c in ("conv", "at", "depth", "x1", "block", "n_bytes", "path", "shard")}
    )
    nodes = prefix_trie.trie_report(turns).collect()
    root = [r for r in nodes if r.depth == 0]
    assert [(r.conv_id, r.n_convs, r.parent_conv_id) for r in root] == [(0, 4, None)]
    assert prefix_trie.trie_report(turns.limit(0)).collect() == []
    assert prefix_trie.trie_report(turns.filter("conv_id IS NULL")).collect() == []


ODD = ("my col", "my-col", "a.b", "a:b", "a,b", "tick`ed", "Ünï")


@pytest.mark.parametrize("name", FILTERS)
def test_a_stage_bears_odd_column_names(spark, name):
    rows = [(i, f"some words of text {i} " * 30, "en", "s1", 3) for i in range(3)]
    docs = spark.createDataFrame(rows, SCHEMA)
    docs = docs.select("*", *[F.lit(f"own {c}").alias(c) for c in ODD])
    made = FILTERS[name](docs)
    assert made.columns == docs.columns
    for row in made.collect():
        assert [row[c] for c in ODD] == [f"own {c}" for c in ODD]


def test_vectors_of_extreme_magnitude(spark):
    rows = [(1, [1e-200, 0.0]), (2, [2e-200, 0.0]), (3, [1.0, 0.0]), (4, [2.0, 0.1]), (5, [0.0, 1e200]),
            (6, [0.0, 3e300]), (7, [5e-324, 0.0]), (8, [-1e300, 1e-300])]
    vectors = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = {r.vec_id: (r.n_links, r.component_id) for r in epsilon_join.linked_vectors(vectors).collect()}
    assert got == {1: (4, 1), 2: (4, 1), 3: (4, 1), 4: (4, 1), 7: (4, 1), 5: (1, 5), 6: (1, 5), 8: (0, 8)}


@pytest.mark.parametrize("rows", [[(1, [1.0, 2.0])] * 9, [(None, [1.0, 2.0])] * 9])
def test_one_repeated_vector(spark, rows):
    vectors = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    got = epsilon_join.linked_vectors(vectors).collect()
    assert {(r.vec_id, r.n_links, r.component_id) for r in got} == {(rows[0][0], 8, rows[0][0])}
