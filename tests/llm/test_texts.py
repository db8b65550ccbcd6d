"""Operators on whole texts against plain Python and the public tokenizer libraries."""

import base64
import random
import re
from collections import Counter
from hashlib import sha256

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerfold.llm import byte_bpe, licenses, pii, quality_mil, quality_rules, token_counts, toxicity
from ledgerfold.llm.text import chunked

JSON = str(public_tokenizers.path("byte_bpe_50k.json"))
RANKS = str(public_tokenizers.path("byte_bpe_50k.tiktoken"))
PIECES = [
    "a", "aa", "th", "er", " ", "  ", "\n", "é", "ß", "日本", "<|endoftext|>", "'s", "'ll", "1", "234",
    "!", "!!!", "---", "====", "　", "\x1c", "\x85", "​", "\xa0", "🙂", "\t", "İ", "²", "\x00",
    "the", "Word", "|", "%%%", " ", ". ", "MIT License", "Apache", "license", "general public ",
]


@pytest.fixture(scope="module")
def texts(spark, sf_dir):
    rng = random.Random(3)
    odd = ["".join(rng.choices(PIECES, k=rng.randint(0, 60))) for _ in range(1500)]
    odd += ["a" * 5000, "=" * 3001, " " * 777, "ab" * 999, "", None, "\n" * 501, "erer" * 300]
    read = spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect()
    return odd + [r.text for r in read]


def test_token_counts(texts):
    library = Tokenizer.from_file(JSON)
    want = [len(library.encode(t or "", add_special_tokens=False).ids) for t in texts]
    got = token_counts.count_texts(texts, JSON)
    assert got["n_tokens"].tolist() == want
    assert got["n_bytes"].tolist() == [len((t or "").encode()) for t in texts]


def test_encoding(texts):
    with open(RANKS, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    library = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    coded = byte_bpe.encode_texts(texts, RANKS, public_tokenizers.PATTERN)["ids"]
    for text, packed in zip(texts, coded, strict=True):
        assert np.frombuffer(packed, "<u4").tolist() == library.encode_ordinary(text or "")
    back = byte_bpe.decode_ids(coded, RANKS, public_tokenizers.PATTERN)["text"]
    assert [b.decode() for b in back] == [t or "" for t in texts]


def test_replay_is_the_same_as_one_by_one():
    rng, table = random.Random(5), byte_bpe.ranks(RANKS, public_tokenizers.PATTERN)
    words = {"".join(rng.choices("aeinorst-=*. ", k=rng.randint(1, 30))) for _ in range(20_000)}
    words = [w.encode() for w in sorted(words)]
    ids, first = table.replay(words)
    for i, word in enumerate(words):
        assert ids[first[i] : first[i + 1]].tolist() == table.one_by_one(word)


def _counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    found = Counter(zip(words, words[1:], words[2:], strict=False))
    again = set()
    for i, window in enumerate(zip(words, words[1:], words[2:], strict=False)):
        if found[window] > 1:
            again |= {i, i + 1, i + 2}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    signs = len(re.findall(r"[#*$%&|<>]", text or ""))
    return len(words), sum(map(len, words)), signs, len(lines) - len(set(lines)), len(again)


def test_rule_counts(texts):
    got = quality_rules.count_texts(texts)
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert list(zip(*(got[c].tolist() for c in names), strict=True)) == [_counts(t) for t in texts]


def test_em_recovers_accuracies():
    rng, k = np.random.default_rng(1), len(quality_rules.rules())
    good = rng.random(20_000) < 0.85
    right = rng.random((20_000, k)) < 0.9
    votes = np.where(right == good[:, None], 2, 0)
    votes[rng.random(votes.shape) < 0.3] = 1
    pattern = (votes * 3 ** np.arange(k - 1, -1, -1)).sum(axis=1)
    known, count = np.unique(pattern, return_counts=True)
    posterior = dict(zip(known, quality_rules.fit(known, count.astype(float)), strict=True))
    assert np.mean((np.array([posterior[p] for p in pattern]) > 0.5) == good) > 0.98


def test_verdicts_follow_labels(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = quality_rules.quality_rules(docs).drop("quality").join(labels, "doc_id").collect()
    assert all((r.base_failed is False) or not r.kept for r in rows)
    judged = [(r.kept, r.quality == 1) for r in rows if not r.base_failed]
    assert np.mean([a == b for a, b in judged]) > 0.97


PLACES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))


def _base(text):
    lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words, found = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower), []
    for phrase, label in PLACES:
        p = phrase.split()
        found += [(i, label) for i in range(len(words)) if words[i : i + len(p)] == p]
    starts = [i for i, _ in found]
    labels = ",".join(sorted({x for _, x in found}))
    return len(words), len(found), min(starts, default=None), max(starts, default=None), labels


def test_license_places(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    for r in licenses.license_labels(docs).collect():
        got = r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels
        assert got == _base(texts[r.doc_id])
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))


def test_edited_notices(spark):
    docs = spark.createDataFrame(
        [
            (1, "This work is now licensed under the GNU General Public-License, in version 3."),
            (2, "Licensed under a Creative Commons public Attribution License"),
            (3, "Licensed under the GNU Lesser General Public License"),
            (4, "rights and all that are reserved; permission is granted to any person"),
            (5, "Licensed under CC-BY-NC 4.0 and then CC-BY-SA"),
        ],
        "doc_id bigint, text string",
    )
    got = {r.doc_id: (r.labels, r.score) for r in licenses.license_labels(docs).collect()}
    assert {k: v[0] for k, v in got.items()} == {
        1: "gpl", 2: "cc-by", 3: "gpl,lgpl", 4: "", 5: "cc-by-nc",
    }
    assert 0.5 < got[2][1] < 1 and got[4][1] == 0


_PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
    "card": r"[0-9](?:[\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def spans(text):
    """Base spans as ``(start, kind, end)`` in order, by the plain patterns."""
    found = []
    for rank, (kind, pattern) in enumerate(_PATTERNS.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            passed = {
                "email": True,
                "ip": kind == "ip" and all(int(p) <= 255 for p in m.group().split(".")),
                "card": 12 <= len(digits) <= 19 and _luhn(digits),
                "phone": 9 <= len(digits) <= 15,
            }
            if passed[kind]:
                found.append((m.start(), rank, m.end(), kind))
    return [(a, kind, b) for a, _, b, kind in sorted(found)]


PERSONAL = [
    "a", "b1", "@", "x.y", ".", "+", "1", "23", "456", "7890", "12345678", " ", "-", "(", ")", "\n", "é",
    "🙂", "4111111111111111", "+1 (415) 555-2671", "10.0.0.1", "255.255.255.256", "me@ex.com", "_", "%",
]


def test_personal_data(spark, texts):
    rng = random.Random(5)
    given = ["".join(rng.choices(PERSONAL, k=rng.randint(0, 40))) for _ in range(1500)]
    given += ["1.2.3.4 " * 2000, "a" * 50_000, "1" * 20_000, "+" * 3000] + texts[-300:]
    docs = spark.createDataFrame(list(enumerate(given)), "doc_id bigint, text string").repartition(8)
    for r in pii.pii_report(docs).collect():
        want = spans(given[r.doc_id])
        told = ",".join(f"{kind}:{a}:{b}" for a, kind, b in want)
        assert r.base_sha256 == sha256(told.encode()).hexdigest()
        kinds = Counter(kind for _, kind, _ in want)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [kinds[k] for k in _PATTERNS]
        assert set(filter(None, told.split(","))) <= set(r.spans.split(","))


def test_boosting_adds_what_looks_alike(spark):
    rng = random.Random(9)
    rows = []
    for i in range(600):
        number = f"({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)}"
        # a few numbers come without the country code that the strict pattern wants
        rows.append((i, f"call {'' if i % 60 == 0 else '+1 '}{number} now, item {rng.randint(1, 99)}"))
    report = pii.pii_report(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    added = [r for r in report if r.doc_id % 60 == 0]
    assert all(r.n_phone == 0 for r in added) and all("phone:" in r.spans for r in added)


def test_boosting_adds_pairs_and_spelt_out_addresses(spark):
    rng = random.Random(10)
    rows = []
    for i in range(900):
        pairs, name = " ".join(f"{rng.randint(10, 99)}" for _ in range(4)), rng.choice(["ann", "li.b", "me"])
        country = "" if i % 60 == 0 else "+33 "
        address = f"{name} at ex dot com" if i % 60 == 0 else f"{name}@ex.com"
        if i % 60 == 30:
            address = f"{name} [at] mail (dot) ex DOT org"
        plain = "look at the dot on it, at noon dot by dot"
        rows.append((i, f"call {country}06 {pairs} or write to {address} now. {plain} {rng.randint(1, 99)}"))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    texts = dict(rows)
    for r in pii.pii_report(docs).collect():
        spans = [s.split(":") for s in r.spans.split(",")]
        found = {(k, texts[r.doc_id][int(a) : int(b)]) for k, a, b in spans}
        number = re.search(r"06(?: [0-9]{2}){4}", texts[r.doc_id])[0]
        address = re.search(r"write to (.*) now", texts[r.doc_id])[1]
        assert ("email", address) in found and r.n_email == (r.doc_id % 30 != 0)
        assert any(k == "phone" and t.endswith(number) for k, t in found)
        assert r.n_phone == (r.doc_id % 60 != 0) and not any("look" in t or "noon" in t for _, t in found)


def test_redaction(spark):
    text = "mail me@ex.com, +1 (415) 555-2671 or 10.0.0.1; é🙂 4111111111111111."
    docs = spark.createDataFrame([(1, text, len(text)), (2, "nothing", 7)], "doc_id long, text string, n_chars int")
    got = {r.doc_id: (r.text, r.n_chars) for r in pii.redact(docs).collect()}
    masked = "mail <EMAIL>, <PHONE> or <IP>; é🙂 <CARD>."
    assert got == {1: (masked, len(masked)), 2: ("nothing", 7)}


def test_running_sums(spark):
    from pyspark.sql import functions as F

    values = [random.Random(n).choices(range(9), k=n) for n in (0, 1, 2, 7, 30, 101)]
    made = spark.createDataFrame([(v,) for v in values], "v array<int>").select(
        "v", pii.running(F.col("v"), lambda a, b: a + b, F.lit(0)).alias("sums")
    )
    for r in made.collect():
        assert r.sums == [sum(r.v[:i]) for i in range(len(r.v))]


def _gradient_error(m, grad, loss):
    worst = 0.0
    for k, g in grad.items():
        at = np.unravel_index(np.argmax(np.abs(g)), g.shape)
        old, e = m[k][at], 1e-5
        m[k][at] = old + e
        up = loss()
        m[k][at] = old - e
        slope, m[k][at] = (up - loss()) / (2 * e), old
        worst = max(worst, abs(slope - g[at]) / max(1e-3, abs(slope)))
    return worst


def test_network_gradient():
    m = {k: v * 3 for k, v in toxicity._start(np.random.default_rng(0)).items()}
    ((_, chunk),) = chunked(["the idiot went home", "some text with more words in it " * 3, "", "a"])
    r, y = toxicity.Reading(chunk), np.array([1.0, 0, 0, 1])

    def loss():
        p = toxicity._sigmoid(toxicity._forward(m, toxicity._inputs(m, r), r.windows)["logit"])
        return -(y * np.log(p) + (1 - y) * np.log(1 - p)).sum()

    assert _gradient_error(m, toxicity.gradient(m, r, r.windows, y, np.ones(4)), loss) < 1e-4


def test_attention_gradient():
    rng = np.random.default_rng(2)
    m, x = quality_mil._start(rng), rng.normal(size=(7, quality_mil.FEATURES))
    counts, y = np.array([3, 1, 3]), np.array([1.0, 0, 1])
    first = np.cumsum(counts) - counts

    def loss():
        p = quality_mil._forward(m, x, first, counts)["p"]
        return -(y * np.log(p) + (1 - y) * np.log(1 - p)).mean()

    f = quality_mil._forward(m, x, first, counts)
    assert _gradient_error(m, quality_mil._gradient(m, x, f, y), loss) < 1e-4


def test_windows_cover_every_word():
    ((_, chunk),) = chunked([" ".join(f"w{i}" for i in range(n)) for n in (0, 1, 32, 33, 57, 500)])
    r = toxicity.Reading(chunk)
    assert r.counts.tolist() == [1, 1, 1, 2, 3, 21]
    assert set(range(len(r.word))) <= set(r.windows.reshape(-1).tolist())


def test_held_out_quality(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = quality_mil.quality_scores(docs, labels).filter("held_out").join(labels, "doc_id").collect()
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.95


def test_all_passages_are_trained(spark, monkeypatch):
    rows = [(1, "word " * 20_000), (2, "some words " * 100)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id bigint, quality int")
    monkeypatch.setattr(quality_mil, "remainder", lambda _: F.lit(0))
    monkeypatch.setattr(quality_mil, "fit", lambda bags, y: ([len(b) for b in bags], y.tolist()))
    assert quality_mil.train(docs, labels) == ([313, 4], [1.0, 0.0])


def test_learnt_toxicity():
    """On texts of its own: some words make a text toxic, some only by how they begin."""
    rng = random.Random(4)

    def text(toxic):
        words = [rng.choice("lorem ipsum dolor sit amet tua res nova via".split()) + str(rng.randint(0, 99)) for _ in range(rng.randint(20, 200))]
        if toxic:
            for _ in range(3):
                words[rng.randrange(len(words))] = rng.choice(["badword", "awful", f"zgrx{rng.choice('abcdef')}{rng.choice('mnop')}"])
        return " ".join(words)

    def sample(n):
        y = np.array([i % 2 for i in range(n)], float)
        return [text(v) for v in y], y

    train, y = sample(400)
    model = toxicity.fit(toxicity._sampled(train)["windows"], y)
    unseen, y = sample(200)
    assert np.mean((toxicity.score_texts(unseen, model)["score"] >= 0.5) == y) > 0.95


def _lorem(rng, n):
    return [rng.choice("lorem ipsum dolor sit amet tua res nova via".split()) + str(rng.randint(0, 99)) for _ in range(n)]


def test_toxic_passages_of_long_texts_are_learnt(spark):
    """One short passage in thousands of words, never where few evenly spaced windows would lie."""
    rng = random.Random(6)

    def text(toxic):
        words = _lorem(rng, rng.randint(1200, 2400))
        if toxic:
            at = rng.randrange(100, len(words) - 100)
            words[at : at + 3] = rng.choices(["badword", "awful", "zgrxam", "zgrxbo"], k=3)
        return " ".join(words)

    rows = [(i, text(i % 2), i % 2) for i in range(240)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id bigint, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id bigint, toxic int")
    got = toxicity.toxicity_scores(docs, labels).filter("held_out").collect()
    assert len(got) > 20 and np.mean([r.predicted == r.doc_id % 2 for r in got]) > 0.95


def test_the_cut_holds_for_long_texts():
    """Words that lean a little stand in clean texts too: the more windows, the higher the highest."""
    rng = random.Random(7)

    def text(toxic, n):
        words = [w if rng.random() > 0.03 else f"hint{rng.randint(0, 9)}" for w in _lorem(rng, n)]
        if toxic:
            at = rng.randrange(n - 10)
            words[at : at + 8] = [f"hint{rng.randint(0, 9)}" for _ in range(8)]
        return " ".join(words)

    train = [text(i % 2, rng.choice([30, 100, 300, 3000])) for i in range(400)]
    model = toxicity.fit(toxicity._sampled(train)["windows"], np.arange(400) % 2.0)
    clean = toxicity.score_texts([text(0, 4000) for _ in range(60)], model)["score"]
    toxic = toxicity.score_texts([text(1, 4000) for _ in range(60)], model)["score"]
    assert np.mean(clean >= 0.5) < 0.1 and np.mean(toxic >= 0.5) > 0.9
