"""Quality by attention-based multiple-instance learning.

A text is a bag of passages of ``PASSAGE`` words. Every passage is encoded from
its characters and words; gated attention, learnt from document labels alone,
weighs the encodings, and the weighted sum is scored. Training runs in numpy on
a bounded sample (``per_class`` labelled documents of each class); training and
scoring read all passages of their texts.

Null and empty texts are a bag of one passage without words and get a score
like any other. Equal texts score alike; without labels of both classes every
score is the share of label 1 (0.5 without any); an empty table gives no rows.
"""

from __future__ import annotations

from functools import partial

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerfold.llm.labels import held_out, labelled_texts, remainder
from ledgerfold.llm.text import chunked, is_space, mapped, repeated, window_hashes

PASSAGE = 64
PER_CLASS = 2000
HIDDEN, GATE, BUCKETS = 16, 8, 48
THRESHOLD = 0.7
# classes of characters, one share of a passage each
KINDS = (
    "lower", "upper", "digit", "stop", "comma", "loud", "symbol", "other",
    "far_lower", "far_upper",
)
FEATURES = len(KINDS) + 6 + BUCKETS

_KIND_OF: list[np.ndarray] = []


def _kind_table() -> np.ndarray:
    """Class of every code point of the basic plane."""
    if not _KIND_OF:
        table = np.full(1 << 16, KINDS.index("other"), np.int64)
        for i in range(1 << 16):
            c = chr(i)
            if c.isalpha():
                upper = c.isupper()
                table[i] = (1 if upper else 0) if i < 128 else (9 if upper else 8)
            elif c.isdigit():
                table[i] = 2
        for kind, marks in ((3, ".;:"), (4, ","), (5, "!?"), (6, "#*$%&|<>=~^@_{}[]\\/+")):
            table[[ord(m) for m in marks]] = kind
        _KIND_OF.append(table)
    return _KIND_OF[0]


def passages(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages, and the number of passages of each text (one at least)."""
    features, counts = [], []
    for _, chunk in chunked(texts):
        n, points = len(chunk.first), chunk.points
        inside = ~is_space(points)
        start, end = chunk.runs(inside)
        owner = chunk.owner(start)
        words = chunk.span_hashes(chunk.prefix_hashes(), start, end)
        per = np.bincount(owner, minlength=n)
        bags = np.maximum(1, -(-per // PASSAGE))
        first_word, first_bag = np.cumsum(per) - per, np.cumsum(bags) - bags
        place = np.arange(len(words)) - first_word[owner]
        bag = first_bag[owner] + place // PASSAGE
        total, length = int(bags.sum()), end - start

        size = np.bincount(bag, minlength=total)
        chars = np.bincount(bag, weights=length, minlength=total)
        bag_of = np.repeat(bag, length)
        text = points[inside]
        kind = _kind_table()[np.minimum(text, 0xFFFF)]
        k = len(KINDS)
        kinds = np.bincount(bag_of * k + kind, minlength=total * k).reshape(total, k)
        pair = (text[:-1].astype(np.int64) * 31 + text[1:]) * 0x9E3779B1 >> 7
        same_word = np.repeat(np.arange(len(words)), length)
        joined = same_word[1:] == same_word[:-1]
        at = bag_of[1:][joined] * BUCKETS + pair[joined] % BUCKETS
        pairs = np.bincount(at, minlength=total * BUCKETS).reshape(total, BUCKETS)

        again = repeated(bag, words)[0]
        two = window_hashes(words, 2)
        in_bag = bag[1:] == bag[:-1] if len(bag) else np.zeros(0, bool)
        again_two = np.zeros(len(words), bool)
        if len(two):
            again_two[1:][in_bag] = repeated(bag[1:][in_bag], two[in_bag])[0]
        stutter = np.zeros(len(words), bool)
        stutter[1:] = (words[1:] == words[:-1]) & in_bag

        def share(mask: np.ndarray, bag: np.ndarray = bag, total: int = total) -> np.ndarray:
            return np.bincount(bag[mask], minlength=total)

        w, c = np.maximum(size, 1), np.maximum(chars, 1)
        shares = [share(again), share(again_two), share(stutter), share(length == 1)]
        made = [kinds / c[:, None], np.stack(shares, axis=1) / w[:, None]]
        made.append(np.stack([np.minimum(chars / w / 10, 3), size / PASSAGE], axis=1))
        made.append(np.sqrt(pairs / np.maximum(pairs.sum(axis=1, keepdims=True), 1)))
        features.append(np.concatenate(made, axis=1).astype(np.float32))
        counts.append(bags)
    if not counts:
        return np.zeros((0, FEATURES), np.float32), np.zeros(0, np.int64)
    return np.concatenate(features), np.concatenate(counts)


Model = dict[str, np.ndarray]


def _start(rng: np.random.Generator) -> Model:
    def weights(*shape: int) -> np.ndarray:
        return rng.normal(0, 1 / np.sqrt(shape[0]), shape)

    return {
        "encode": weights(FEATURES, HIDDEN),
        "bias": np.zeros(HIDDEN),
        "tanh": weights(HIDDEN, GATE),
        "gate": weights(HIDDEN, GATE),
        "weigh": weights(GATE, 1),
        "out": weights(HIDDEN, 1),
        "base": np.zeros(1),
    }


def _forward(m: Model, x: np.ndarray, first: np.ndarray, counts: np.ndarray) -> dict:
    """Encodings, attention and score of bags whose passages stand one after another."""
    bag = np.repeat(np.arange(len(counts)), counts)
    h = np.tanh(x @ m["encode"] + m["bias"])
    t, g = np.tanh(h @ m["tanh"]), 1 / (1 + np.exp(-(h @ m["gate"])))
    a = (t * g @ m["weigh"])[:, 0]
    a = np.exp(a - np.maximum.reduceat(a, first)[bag])
    a = a / np.add.reduceat(a, first)[bag]
    z = np.add.reduceat(h * a[:, None], first, axis=0)
    logit = np.clip((z @ m["out"])[:, 0] + m["base"][0], -30, 30)
    return {"bag": bag, "h": h, "t": t, "g": g, "a": a, "z": z, "p": 1 / (1 + np.exp(-logit))}


def _gradient(m: Model, x: np.ndarray, f: dict, y: np.ndarray) -> Model:
    n, bag, h, a, t, g = len(y), f["bag"], f["h"], f["a"], f["t"], f["g"]
    d = (f["p"] - y)[:, None] / n
    dz = (d * m["out"][:, 0])[bag]
    score = (dz * (h - f["z"][bag])).sum(axis=1, keepdims=True) * a[:, None]
    dt, dg = score * m["weigh"][:, 0] * g * (1 - t * t), score * m["weigh"][:, 0] * t * g * (1 - g)
    dh = dz * a[:, None] + dt @ m["tanh"].T + dg @ m["gate"].T
    dpre = dh * (1 - h * h)
    return {
        "encode": x.T @ dpre,
        "bias": dpre.sum(axis=0),
        "tanh": h.T @ dt,
        "gate": h.T @ dg,
        "weigh": (t * g).T @ score,
        "out": f["z"].T @ d,
        "base": d.sum(axis=0),
    }


def fit(bags: list[np.ndarray], labels: np.ndarray, epochs: int = 40, seed: int = 7) -> Model:
    """Train on bags of passages with labels 0 and 1, by Adam on batches of 64 bags."""
    rng = np.random.default_rng(seed)
    m = _start(rng)
    share = float(labels.mean()) if len(labels) else 0.5
    if len(labels) == 0 or share in (0.0, 1.0):
        m["out"][:] = 0
        m["base"][:] = np.log((share + 1e-3) / (1 - share + 1e-3))
        return m | {"mean": np.zeros(FEATURES), "scale": np.ones(FEATURES)}
    # bags stay as they are, in single precision; a batch is scaled when its turn comes
    number = sum(len(b) for b in bags)
    mean = sum(b.sum(axis=0, dtype=float) for b in bags) / number
    scale = np.sqrt(sum(((b - mean) ** 2).sum(axis=0) for b in bags) / number) + 0.02
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in m.items()}
    step, rate = 0, 0.01
    for epoch in range(epochs):
        order = rng.permutation(len(bags))
        for at in range(0, len(order), 64):
            part = order[at : at + 64]
            counts = np.array([len(bags[i]) for i in part])
            x = (np.concatenate([bags[i] for i in part]) - mean) / scale
            first = np.cumsum(counts) - counts
            grad = _gradient(m, x, _forward(m, x, first, counts), labels[part])
            step += 1
            now = rate * (1 - epoch / epochs)
            for k, (m1, m2) in moments.items():
                slope = grad[k] + 1e-4 * m[k] * (k not in ("bias", "base"))
                m1 += 0.1 * (slope - m1)
                m2 += 0.001 * (slope * slope - m2)
                m[k] -= now * (m1 / (1 - 0.9**step)) / (np.sqrt(m2 / (1 - 0.999**step)) + 1e-8)
    return m | {"mean": mean, "scale": scale}


def score_texts(texts: list[str | None], model: Model) -> dict[str, np.ndarray]:
    x, counts = passages(texts)
    if not len(counts):
        return {"score": np.zeros(0)}
    x = (x - model["mean"]) / model["scale"]
    return {"score": _forward(model, x, np.cumsum(counts) - counts, counts)["p"]}


def _encoded(texts: list[str | None]) -> dict[str, list[bytes]]:
    x, counts = passages(texts)
    parts = np.split(x, np.cumsum(counts)[:-1]) if len(counts) else []
    return {"bag": [p.tobytes() for p in parts]}


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Model:
    """A model from the labelled documents outside the held-out fold."""
    rows = labelled_texts(docs, labels, "quality", remainder(4) != 2, per_class)
    once = mapped(_encoded, ("doc_id", "label"))
    coded = rows.mapInArrow(once, "doc_id bigint, label int, bag binary")
    # at most 2 * per_class rows; by id, so that task order does not change the model
    got = sorted((r.doc_id, r.label, bytes(r.bag)) for r in coded.collect())
    bags = [np.frombuffer(b, np.float32).reshape(-1, FEATURES) for _, _, b in got]
    return fit(bags, np.array([y for _, y, _ in got], float))


def quality_scores(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` of every document."""
    model = train(docs, labels, per_class)
    score = mapped(partial(score_texts, model=model), ("doc_id",))
    scored = docs.select("doc_id", "text").mapInArrow(score, "doc_id bigint, score double")
    predicted = (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    return scored.select("doc_id", held_out(4, 2), "score", predicted)
