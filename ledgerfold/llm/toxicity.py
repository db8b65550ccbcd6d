"""Toxicity by a bidirectional gated recurrent network with attention pooling.

The words of a text (runs of letters, digits and characters beyond ASCII) are read
in overlapping windows. A word enters as the vector of its hash and the mean of
the vectors of its character triples; two gated recurrent layers read a window
in both directions, attention pools their states, and a text scores as its most
toxic window. Training runs in numpy on a bounded sample (``per_class`` labelled
texts of each class): only texts have labels, so the highest windows of each are
trained, chosen anew round by round among all its windows. The sample stays on
the cluster, whose tasks count its words and choose; the driver holds the chosen
windows alone. Scoring reads all windows of all texts.

Null and empty texts are one window without words and get a score like any
other. Equal texts score alike; without labels of both classes every score is
the share of label 1 (0.5 without any); an empty table gives no rows.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerfold.llm.labels import held_out, labelled_texts, remainder
from ledgerfold.llm.text import CHUNK, Chunk, chunked, mapped, mixed

WINDOW, STRIDE = 32, 24
PER_CLASS = 2000
# windows of a text that are trained in a round, by its label; tasks the sample is dealt to
TOPS, PARTS = (3, 1), 16
THRESHOLD, CAUTION = 0.5, 3.0
WORDS, TRIPLES = 1 << 14, 1 << 13
WORD_SIZE, TRIPLE_SIZE, HIDDEN, ATTEND = 8, 8, 8, 8
_GOLD = np.uint64(0x9E3779B97F4A7C15)

Model = dict[str, np.ndarray]
# calls a function on the windows and labels of some texts of the sample, given as a mask;
# makes numbers of texts with what the function says of them
Each = Callable[[Callable, np.ndarray], list[tuple[np.ndarray, object]]]


class Reading:
    """Words of a chunk: buckets of words and triples, and windows as word numbers.

    The triples of all words stand one after another, ``lengths`` to each word. A
    window is padded with the number of words, which stands for no word.
    """

    leaning: np.ndarray | None = None

    def __init__(self, chunk: Chunk) -> None:
        c = chunk.points
        lower = np.where((c >= 0x41) & (c <= 0x5A), c + 0x20, c)
        inside = ((lower >= 0x30) & (lower <= 0x39)) | ((lower >= 0x61) & (lower <= 0x7A))
        inside |= lower >= 0x80
        self.start, self.end = chunk.runs(inside)
        n, self.lengths = len(chunk.first), self.end - self.start
        hashes = chunk.span_hashes(chunk.prefix_hashes(lower), self.start, self.end)
        self.word = (hashes % np.uint64(WORDS)).astype(np.int64)
        at = np.flatnonzero(inside)
        shown = np.where(inside, lower, 0x20).astype(np.uint64)
        shown = np.concatenate(([np.uint64(0x20)], shown, [np.uint64(0x20)]))
        triple = shown[at] * np.uint64(1 << 42) + shown[at + 1] * np.uint64(1 << 21) + shown[at + 2]
        self.triple = (mixed(triple * _GOLD) % np.uint64(TRIPLES)).astype(np.int64)
        per = np.bincount(chunk.owner(self.start), minlength=n)
        first = np.cumsum(per) - per
        self.counts = np.maximum(1, -(-np.maximum(per - WINDOW, 0) // STRIDE) + 1)
        text = np.repeat(np.arange(n), self.counts)
        turn = np.arange(len(text)) - np.repeat(np.cumsum(self.counts) - self.counts, self.counts)
        begin = turn * STRIDE
        place = begin[:, None] + np.arange(WINDOW)
        none = len(self.word)
        self.windows = np.where(place < per[text][:, None], first[text][:, None] + place, none)


def _start(rng: np.random.Generator) -> Model:
    size, h = WORD_SIZE + TRIPLE_SIZE, HIDDEN
    model = {
        "word": rng.normal(0, 0.05, (WORDS, WORD_SIZE)),
        "triple": rng.normal(0, 0.05, (TRIPLES, TRIPLE_SIZE)),
        "attend": rng.normal(0, 0.3, (2 * h, ATTEND)),
        "weigh": rng.normal(0, 0.3, (ATTEND, 1)),
        "out": rng.normal(0, 0.3, (2 * h, 1)),
        "base": np.zeros(1),
    }
    for way in ("ahead", "back"):
        model[f"{way}_in"] = rng.normal(0, 1 / np.sqrt(size), (size, 3 * h))
        model[f"{way}_bias"] = np.zeros(3 * h)
        model[f"{way}_gates"] = rng.normal(0, 1 / np.sqrt(h), (h, 2 * h))
        model[f"{way}_state"] = rng.normal(0, 1 / np.sqrt(h), (h, h))
    return model


def _inputs(m: Model, r: Reading) -> np.ndarray:
    """Vectors of the words; the last row, of zeros, is for no word."""
    made = np.zeros((len(r.word) + 1, WORD_SIZE + TRIPLE_SIZE), m["word"].dtype)
    if len(r.word):
        made[:-1, :WORD_SIZE] = m["word"][r.word]
        begins = np.cumsum(r.lengths) - r.lengths
        sums = np.add.reduceat(m["triple"][r.triple], begins, axis=0)
        made[:-1, WORD_SIZE:] = sums / r.lengths[:, None].astype(made.dtype)
        if r.leaning is not None:
            made[:-1, [0, WORD_SIZE]] = r.leaning
    return made


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _recur(m: Model, way: str, x: np.ndarray, windows: np.ndarray, tape: list | None) -> np.ndarray:
    """States of one direction over all windows, in the order of the words."""
    h = HIDDEN
    entering = x @ m[f"{way}_in"] + m[f"{way}_bias"]
    none = len(x) - 1
    state = np.zeros((len(windows), h), x.dtype)
    states = np.zeros((WINDOW, len(windows), h), x.dtype)
    steps = range(WINDOW) if way == "ahead" else range(WINDOW - 1, -1, -1)
    for t in steps:
        at = windows[:, t]
        given = entering[at]
        gates = _sigmoid(given[:, : 2 * h] + state @ m[f"{way}_gates"])
        keep, reset = gates[:, :h], gates[:, h:]
        shown = reset * state
        fresh = np.tanh(given[:, 2 * h :] + shown @ m[f"{way}_state"])
        there = (at != none)[:, None]
        after = np.where(there, fresh + keep * (state - fresh), state)
        if tape is not None:
            tape.append((t, at, there, state, keep, reset, shown, fresh))
        state = after
        states[t] = state
    return states


def _forward(m: Model, x: np.ndarray, windows: np.ndarray, taped: bool = False) -> dict:
    tapes: dict[str, list | None] = {w: [] if taped else None for w in ("ahead", "back")}
    parts = [_recur(m, way, x, windows, tapes[way]) for way in ("ahead", "back")]
    states = np.concatenate(parts, axis=2)
    seen = np.tanh(states @ m["attend"])
    weight = (seen @ m["weigh"])[:, :, 0]
    weight = np.where(windows.T != len(x) - 1, weight, -1e9)
    weight = np.exp(weight - weight.max(axis=0))
    weight /= weight.sum(axis=0)
    pooled = np.einsum("tb,tbh->bh", weight, states)
    logit = (pooled @ m["out"])[:, 0] + m["base"][0]
    return {
        "tapes": tapes, "states": states, "seen": seen, "weight": weight,
        "pooled": pooled, "logit": np.clip(logit, -30, 30),
    }


def gradient(m: Model, r: Reading, windows: np.ndarray, y: np.ndarray, importance: np.ndarray) -> Model:
    """Gradient of the weighted cross entropy over some windows."""
    h = HIDDEN
    x = _inputs(m, r)
    f = _forward(m, x, windows, taped=True)
    d = (importance * (_sigmoid(f["logit"]) - y))[:, None]
    grad = {k: np.zeros_like(v) for k, v in m.items()}
    grad["out"], grad["base"] = f["pooled"].T @ d, d.sum(axis=0)
    dpooled = d @ m["out"].T
    weight, states, seen = f["weight"], f["states"], f["seen"]
    dstates = weight[:, :, None] * dpooled
    along = np.einsum("bh,tbh->tb", dpooled, states)
    dweight = weight * (along - (weight * along).sum(axis=0))
    dseen = dweight[:, :, None] * m["weigh"][:, 0] * (1 - seen * seen)
    grad["weigh"] = np.einsum("tbk,tb->k", seen, dweight)[:, None]
    grad["attend"] = np.einsum("tbh,tbk->hk", states, dseen)
    dstates += dseen @ m["attend"].T
    dx = np.zeros_like(x)
    for i, way in enumerate(("ahead", "back")):
        arriving = dstates[:, :, i * h : (i + 1) * h]
        dstate = np.zeros((len(windows), h))
        dgiven = np.zeros((len(x), 3 * h))
        for t, at, there, state, keep, reset, shown, fresh in reversed(f["tapes"][way]):
            dafter = (dstate + arriving[t]) * there
            passed = (dstate + arriving[t]) * ~there
            dfresh = dafter * (1 - keep) * (1 - fresh * fresh)
            dkeep = dafter * (state - fresh) * keep * (1 - keep)
            dshown = dfresh @ m[f"{way}_state"].T
            dreset = dshown * state * reset * (1 - reset)
            dgates = np.concatenate((dkeep, dreset), axis=1)
            grad[f"{way}_state"] += shown.T @ dfresh
            grad[f"{way}_gates"] += state.T @ dgates
            np.add.at(dgiven, at, np.concatenate((dgates, dfresh), axis=1))
            dstate = passed + dafter * keep + dshown * reset + dgates @ m[f"{way}_gates"].T
        dgiven[-1] = 0
        grad[f"{way}_in"] = x.T @ dgiven
        grad[f"{way}_bias"] = dgiven.sum(axis=0)
        dx += dgiven @ m[f"{way}_in"].T
    used = np.flatnonzero(dx[:-1].any(axis=1))
    np.add.at(grad["word"], r.word[used], dx[used, :WORD_SIZE])
    begins = np.cumsum(r.lengths) - r.lengths
    spread = np.repeat(used, r.lengths[used])
    within = np.arange(len(spread)) - np.repeat(
        np.cumsum(r.lengths[used]) - r.lengths[used], r.lengths[used]
    )
    triple = r.triple[begins[spread] + within]
    np.add.at(grad["triple"], triple, (dx[:, WORD_SIZE:][spread] / r.lengths[spread][:, None]))
    return grad


def _lean(toxic: np.ndarray, clean: np.ndarray) -> np.ndarray:
    """How much more often toxic texts hold something, against the noise of its count."""
    return np.clip((toxic - clean) / np.sqrt(toxic + clean + 4) / 3, -1, 1)


def _holding(bucket: np.ndarray, doc: np.ndarray, labels: np.ndarray, size: int) -> np.ndarray:
    """The number of clean and of toxic texts that hold every bucket."""
    pairs = np.unique(doc * size + bucket)
    toxic = labels[pairs // size] > 0
    return np.stack([np.bincount(pairs[toxic == v] % size, minlength=size) for v in (False, True)])


def _others(bucket: np.ndarray, own: np.ndarray, counts: np.ndarray, ratio: float) -> np.ndarray:
    """The lean of every occurrence as the other texts have it."""
    return _lean(counts[1][bucket] - own, (counts[0][bucket] - ~own) * ratio)


def _part(r: Reading, picked: np.ndarray) -> Reading:
    """A reading of some windows of another alone."""
    made, windows = Reading.__new__(Reading), r.windows[picked]
    there = windows != len(r.word)
    at = windows[there]
    made.word, made.lengths, made.leaning = r.word[at], r.lengths[at], r.leaning[at]
    begins = (np.cumsum(r.lengths) - r.lengths)[at]
    ends = np.cumsum(made.lengths)
    within = np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - made.lengths, made.lengths)
    made.triple = r.triple[np.repeat(begins, made.lengths) + within]
    made.windows = np.full(windows.shape, len(at))
    made.windows[there] = np.arange(len(at))
    return made


def _read(texts: list[list[str]]) -> Reading:
    """All windows of some texts as one reading; ``doc`` is the text of every word."""
    readings = [Reading(chunk) for _, chunk in chunked([w for windows in texts for w in windows])]
    made = Reading.__new__(Reading)
    made.word = np.concatenate([r.word for r in readings])
    made.triple = np.concatenate([r.triple for r in readings])
    made.lengths = np.concatenate([r.lengths for r in readings])
    # a window of the sample is a text of one window here
    sizes = np.concatenate([(r.windows != len(r.word)).sum(axis=1) for r in readings])
    made.doc = np.repeat(np.repeat(np.arange(len(texts)), [len(w) for w in texts]), sizes)
    place = (np.cumsum(sizes) - sizes)[:, None] + np.arange(WINDOW)
    made.windows = np.where(np.arange(WINDOW) < sizes[:, None], place, len(made.word))
    return made


def _groups(texts: list[list[str]]) -> Iterator[slice]:
    """The texts in groups of about ``CHUNK`` code points."""
    start = size = 0
    for i, windows in enumerate(texts):
        n = sum(map(len, windows))
        if i > start and size + n > CHUNK:
            yield slice(start, i)
            start, size = i, 0
        size += n
    if start < len(texts):
        yield slice(start, len(texts))


def _counted(texts: list[list[str]], labels: np.ndarray) -> list[np.ndarray]:
    """The numbers of texts by word and by triple, over all windows."""
    words, triples = np.zeros((2, WORDS), np.int64), np.zeros((2, TRIPLES), np.int64)
    for group in _groups(texts):
        r = _read(texts[group])
        words += _holding(r.word, r.doc, labels[group], WORDS)
        triples += _holding(r.triple, np.repeat(r.doc, r.lengths), labels[group], TRIPLES)
    return [words, triples]


def _leaning(
    r: Reading, labels: np.ndarray, counts: list[np.ndarray], ratio: float
) -> np.ndarray:
    """The first dimension of the vectors in training: what the counts tell.

    An occurrence has it as counted on the other texts, or the network would learn to
    trust words that only its own text holds.
    """
    own = labels[r.doc] > 0
    words = _others(r.word, own, counts[0], ratio)
    triples = _others(r.triple, np.repeat(own, r.lengths), counts[1], ratio)
    begins = np.cumsum(r.lengths) - r.lengths
    mean = np.add.reduceat(triples, begins) / r.lengths if len(begins) else triples
    return np.stack([words, mean], axis=1)


def _logits(r: Reading, model: Model) -> np.ndarray:
    x, logits = _inputs(model, r), [np.zeros(0)]
    for at in range(0, len(r.windows), 4096):
        logits.append(_forward(model, x, r.windows[at : at + 4096])["logit"])
    return np.concatenate(logits)


def _highest(
    texts: list[list[str]],
    labels: np.ndarray,
    counts: list[np.ndarray],
    ratio: float,
    model: Model | None,
) -> list[tuple[float, list[str]]]:
    """The highest logit over all windows of every text, and its highest windows."""
    found = []
    for group in _groups(texts):
        some, y = texts[group], labels[group]
        r = _read(some)
        r.leaning = _leaning(r, y, counts, ratio)
        if model is None:
            # until the network can tell, a text's highest window is the one that leans most
            heights = np.append(r.leaning.max(axis=1), -1.0)[r.windows].max(axis=1)
        else:
            heights = _logits(r, model)
        ends = np.cumsum([len(windows) for windows in some])
        for windows, own, label in zip(some, np.split(heights, ends[:-1]), y, strict=True):
            top = np.argsort(-own, kind="stable")[: TOPS[int(label)]]
            found.append((float(own[top[0]]), [windows[i] for i in top]))
    return found


def _cut(logit: np.ndarray, labels: np.ndarray) -> float:
    """The logit that best parts toxic from clean texts the network was not trained on.

    A clean text taken for toxic weighs ``CAUTION`` times as much as a toxic one
    that is missed.
    """
    toxic, clean = np.sort(logit[labels > 0]), np.sort(logit[labels == 0])
    if not len(toxic) or not len(clean):
        return 0.0
    every = np.sort(logit)
    cuts = (every[1:] + every[:-1]) / 2
    cost = np.searchsorted(toxic, cuts) / len(toxic) + CAUTION * (
        1 - np.searchsorted(clean, cuts) / len(clean)
    )
    best = cuts[cost <= cost.min() + 1e-12]
    return float((best[0] + best[-1]) / 2)


def fit(texts: list[list[str]], labels: np.ndarray, steps: int = 500, seed: int = 11) -> Model:
    """Train on the windows of texts with labels 0 and 1, by Adam on ``steps`` batches of 64
    texts at least."""

    def here(ask: Callable, wanted: np.ndarray) -> list[tuple[np.ndarray, object]]:
        number = np.flatnonzero(wanted)
        return [(number, ask([texts[i] for i in number], labels[number]))]

    return _fit(here, labels, steps, seed)


def _fit(each: Each, labels: np.ndarray, steps: int = 500, seed: int = 11) -> Model:
    rng = np.random.default_rng(seed)
    m = _start(rng)
    share = float(labels.mean()) if len(labels) else 0.5
    if len(labels) == 0 or share in (0.0, 1.0):
        m["out"][:] = 0
        m["base"][:] = np.log((share + 1e-3) / (1 - share + 1e-3))
        return m
    kept_back = np.arange(len(labels)) % 5 == 0
    ratio = float(labels.sum() / (len(labels) - labels.sum()))
    parts = [made for _, made in each(_counted, labels >= 0)]
    counts = [sum(part[i] for part in parts) for i in (0, 1)]
    m["word"][:, 0], m["triple"][:, 0] = (_lean(c[1], c[0] * ratio) for c in counts)

    def highest(wanted: np.ndarray, model: Model | None) -> dict[int, tuple[float, list[str]]]:
        quick = model and {k: v.astype(np.float32) for k, v in model.items()}
        ask = partial(_highest, counts=counts, ratio=ratio, model=quick)
        made = each(ask, wanted)
        return {i: one for number, some in made for i, one in zip(number, some, strict=True)}

    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in m.items()}
    balance = np.where(labels > 0, 0.5 / share, 0.5 / (1 - share))
    slow = 0.05 * min(1.0, len(labels) / 2000)
    step, epochs = 0, max(8, -(-64 * steps // len(labels)))
    trained = np.flatnonzero(~kept_back)
    for epoch in range(epochs if len(trained) else 0):
        if epoch % max(2, epochs // 8) == 0:
            chosen = highest(~kept_back, m if epoch else None)
            tops = [chosen[i][1] if i in chosen else [] for i in range(len(labels))]
            whole = _read(tops)
            whole.leaning = _leaning(whole, labels, counts, ratio)
            n = np.array([len(t) for t in tops])
            firsts = np.cumsum(n) - n
        order = rng.permutation(trained)
        for at in range(0, len(order), 64):
            batch = order[at : at + 64]
            of = np.repeat(batch, n[batch])
            importance = balance[of] / np.bincount(of, minlength=len(labels))[of] / 64
            picked = np.concatenate([np.arange(firsts[i], firsts[i] + n[i]) for i in batch])
            part = _part(whole, picked)
            grad = gradient(m, part, part.windows, labels[of], importance)
            step += 1
            rate = 0.01 * (1 - 0.9 * epoch / epochs)
            for k, (m1, m2) in moments.items():
                vectors = k in ("word", "triple")
                slope = grad[k] + 1e-4 * m[k]
                m1 += 0.1 * (slope - m1)
                m2 += 0.001 * (slope * slope - m2)
                change = (m1 / (1 - 0.9**step)) / (np.sqrt(m2 / (1 - 0.999**step)) + 1e-8)
                if vectors:
                    # slowly, or rare words are learnt by heart; the counted dimension stays
                    m[k][:, 1:] -= slow * rate * change[:, 1:]
                else:
                    m[k] -= rate * change
    # as in scoring, a text's logit is the highest of all its windows
    heights = highest(kept_back, m)
    logit = np.array([heights[i][0] for i in np.flatnonzero(kept_back)])
    m["base"] -= _cut(logit, labels[kept_back])
    return m


def score_texts(texts: list[str | None], model: Model) -> dict[str, np.ndarray]:
    scores = [np.zeros(0)]
    for _, chunk in chunked(texts):
        r = Reading(chunk)
        first = np.cumsum(r.counts) - r.counts
        scores.append(_sigmoid(np.maximum.reduceat(_logits(r, model), first)))
    return {"score": np.concatenate(scores).astype(np.float64)}


def _sampled(texts: list[str | None]) -> dict[str, list[list[str]]]:
    """Texts of all windows of each text."""
    made = []
    for text in texts:
        (_, chunk), *_ = chunked([text])
        r = Reading(chunk)
        spoken = []
        for window in r.windows:
            own = window[window < len(r.word)]
            spoken.append((text or "")[r.start[own[0]] : r.end[own[-1]]] if len(own) else "")
        made.append(spoken)
    return {"windows": made}


def _asked(
    batches: Iterator[pa.RecordBatch],
    ask: Callable,
    ids: np.ndarray,
    labels: np.ndarray,
    wanted: np.ndarray,
) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        number = np.searchsorted(ids, batch.column("doc_id").to_numpy())
        mine = wanted[number]
        if mine.any():
            number, texts = number[mine], batch.column("windows").filter(pa.array(mine))
            made = pickle.dumps((number, ask(texts.to_pylist(), labels[number])))
            yield pa.RecordBatch.from_arrays([pa.array([made])], ["made"])


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Model:
    """A model from the labelled documents outside the held-out fold."""
    rows = labelled_texts(docs, labels, "toxic", remainder(5) != 0, per_class)
    dealt = rows.repartition(PARTS).sortWithinPartitions("doc_id")
    sample = dealt.mapInArrow(
        mapped(_sampled, ("doc_id", "label")), "doc_id bigint, label int, windows array<string>"
    ).persist()
    # by id, so that task order does not change the model
    got = sorted((r.doc_id, r.label) for r in sample.select("doc_id", "label").collect())
    ids, y = np.array([i for i, _ in got], np.int64), np.array([v for _, v in got], float)

    def spread(ask: Callable, wanted: np.ndarray) -> list[tuple[np.ndarray, object]]:
        run = partial(_asked, ask=ask, ids=ids, labels=y, wanted=wanted)
        made = sample.select("doc_id", "windows").mapInArrow(run, "made binary")
        return [pickle.loads(r.made) for r in made.collect()]

    try:
        return _fit(spread, y)
    finally:
        sample.unpersist()


def toxicity_scores(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` of every document."""
    model = {k: v.astype(np.float32) for k, v in train(docs, labels, per_class).items()}
    score = mapped(partial(score_texts, model=model), ("doc_id",))
    scored = docs.select("doc_id", "text").mapInArrow(score, "doc_id bigint, score double")
    predicted = (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    return scored.select("doc_id", held_out(5, 0), "score", predicted)
