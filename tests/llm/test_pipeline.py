"""The whole pipeline against a version of plain Python, and what the queries promise."""

import base64
import sys
from collections import Counter
from hashlib import sha256
from pathlib import Path

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken

sys.path.insert(0, str(Path(__file__).parent))

from test_links import classes  # noqa: E402
from test_texts import spans  # noqa: E402

import __spark_entry__ as driver  # noqa: E402
import corpus_pipeline  # noqa: E402
from ledgerfold.llm import mixing, quality_rules  # noqa: E402

SMALL = "/root/testdata/sf0.001"


def _pattern(counts):
    """The votes on one text as a number, from its counts."""

    def share(part, whole, bad, good):
        a, b = counts[part], counts[whole]
        return 0 if b == 0 else -1 if a > bad * b else 1 if a <= good * b else 0

    n, chars = counts["n_words"], counts["word_chars"]
    size = 0 if n == 0 else -1 if chars < 2.5 * n or chars > 12 * n else int(3 * n <= chars <= 9 * n)
    votes = [
        share("n_odd_chars", "word_chars", 0.09, 0.06),
        share("n_odd_words", "n_words", 0.25, 0.1),
        share("n_repeat_words", "n_words", 0.3, 0.1),
        share("n_stutter", "n_words", 0.1, 0.02),
        share("n_dup_lines", "n_lines", 0.3, 0.0),
        size,
        -1 if n < 20 else int(n >= 100),
    ]
    code = 0
    for v in votes:
        code = code * 3 + v + 1
    return code


def _good(docs):
    made = quality_rules.count_texts([d["text"] for d in docs])
    counts = [{c: int(made[c][i]) for c in made} for i in range(len(docs))]
    patterns = [_pattern(c) for c in counts]
    tally = sorted(Counter(patterns).items())
    chance = quality_rules.fit(np.array([p for p, _ in tally]), np.array([float(n) for _, n in tally]))
    known = dict(zip([p for p, _ in tally], chance, strict=True))
    return [
        d for d, c, p in zip(docs, counts, patterns, strict=True)
        if c["n_words"] >= 50 and 2 * c["n_repeat_words"] <= c["n_words"] and known[p] >= 0.5
    ]


def _redacted(text):
    made, at = [], 0
    for a, kind, b in spans(text):
        if a >= at:
            made.append(text[at:a] + f"<{kind.upper()}>")
        at = max(at, b)
    return "".join(made) + text[at:]


def test_pipeline_against_plain_python(spark):
    read = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    docs = _good(sorted((r.asDict() for r in read), key=lambda d: d["doc_id"]))
    first = classes([d["text"] for d in docs])
    docs = [d for i, d in enumerate(docs) if first[i] == i]
    docs = [d | {"text": _redacted(d["text"])} for d in docs]
    con = duckdb.connect()
    con.sql("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, source VARCHAR)")
    con.executemany(
        "INSERT INTO documents VALUES (?, ?, ?)", [(d["doc_id"], d["text"], d["source"]) for d in docs]
    )
    drawn = con.sql(f"SELECT doc_id FROM ({mixing.mixing_sql()})").fetchall()
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    library = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    text_of = {d["doc_id"]: d["text"] for d in docs}
    want = []
    for (doc_id,) in drawn:
        ids = library.encode_ordinary(text_of[doc_id])
        packed = b"".join(i.to_bytes(4, "little") for i in ids)
        decoded = sha256(text_of[doc_id].encode()).hexdigest()
        want.append((doc_id, len(ids), sha256(packed).hexdigest(), decoded))
    got = [tuple(r) for r in corpus_pipeline.run(spark, SMALL).collect()]
    assert len(got) > 100 and sorted(got) == sorted(want)


def test_stages_return_the_columns_of_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SMALL).columns == docs.columns


@pytest.mark.parametrize("name", sorted(q for q in driver.oracle_sql() if q[:2] == "op" and q[2].isdigit()))
def test_queries_with_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings", "conversations"):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    want = con.sql(driver.oracle_sql()[name])
    order = sorted(want.columns)
    got = driver.queries()[name](spark, sf_dir).select(*order).collect()
    assert sorted(map(tuple, got)) == sorted(want.select(*order).fetchall())
