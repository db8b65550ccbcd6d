"""Weak supervision: rules vote on every text, EM weighs the rules, the posterior decides.

Each rule says good (+1), bad (-1) or abstains (0). Expectation-maximisation over
the counts of all vote patterns in the corpus estimates how often each rule casts
each vote on good and on bad texts. There are at most ``3 ** len(rules())``
patterns, so their counts and posteriors are small whatever the corpus holds.

Null and empty texts have no words: counts of zero, and they fail the base test.
Repeated rows are judged one by one and alike; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerfold.llm.text import (
    chunked,
    is_space,
    mapped,
    per_text,
    repeated,
    window_hashes,
)

SYMBOLS = "#*$%&|<>"
COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_odd_chars", "n_odd_words", "n_stutter",
)
# Marks that words of ordinary prose carry.
PROSE_MARKS = ".,;:'\"()-?\u2019\u201c\u201d\u201e\u00ab\u00bb\u00bf\u00a1"
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50


def _share_rule(part: str, whole: str, bad: float, good: float) -> Column:
    """Bad above one share, good at or below another, silent between and without words."""
    a, b = F.col(part), F.col(whole)
    return F.when(b == 0, 0).when(a > bad * b, -1).when(a <= good * b, 1).otherwise(0)


def _length_rule() -> Column:
    n = F.col("n_words")
    return F.when(n < 20, -1).when(n >= 100, 1).otherwise(0)


def _word_size_rule() -> Column:
    n, chars = F.col("n_words"), F.col("word_chars")
    odd, usual = (chars < 2.5 * n) | (chars > 12 * n), chars.between(3 * n, 9 * n)
    return F.when(n == 0, 0).when(odd, -1).when(usual, 1).otherwise(0)


def rules() -> dict[str, Column]:
    """One vote each. Rules that look at the same fault from two sides corroborate one
    another, so a single strange property does not yet make a text bad."""
    return {
        "odd_chars": _share_rule("n_odd_chars", "word_chars", 0.09, 0.06),
        "odd_words": _share_rule("n_odd_words", "n_words", 0.25, 0.1),
        "repeats": _share_rule("n_repeat_words", "n_words", 0.3, 0.1),
        "stutter": _share_rule("n_stutter", "n_words", 0.1, 0.02),
        "lines": _share_rule("n_dup_lines", "n_lines", 0.3, 0.0),
        "word_size": _word_size_rule(),
        "length": _length_rule(),
    }


_LETTERS: list[tuple[np.ndarray, np.ndarray]] = []


def letter_tables() -> tuple[np.ndarray, np.ndarray]:
    """By code point of the basic plane: is a letter, is upper case."""
    if not _LETTERS:
        basic = [chr(i) for i in range(1 << 16)]
        tables = [c.isalpha() for c in basic], [c.isupper() for c in basic]
        _LETTERS.append((np.array(tables[0]), np.array(tables[1])))
    return _LETTERS[0]


def _looked_up(table: np.ndarray, points: np.ndarray) -> np.ndarray:
    return table[np.minimum(points, 0xFFFF)] & (points <= 0xFFFF)


def _one_of(points: np.ndarray, marks: str) -> np.ndarray:
    return np.isin(points, np.frombuffer(marks.encode("utf-32-le"), "<u4"))


def count_texts(texts: list[str | None]) -> dict[str, np.ndarray]:
    """The counts of every whole text."""
    made: dict[str, list[np.ndarray]] = {c: [] for c in COUNTS}
    for _, chunk in chunked(texts):
        n, points = len(chunk.first), chunk.points
        inside = ~is_space(points)
        start, end = chunk.runs(inside)
        owner, sums = chunk.owner(start), chunk.prefix_hashes()
        words = chunk.span_hashes(sums, start, end)
        upper = _looked_up(letter_tables()[1], points)
        plain = _looked_up(letter_tables()[0], points) | _one_of(points, PROSE_MARKS)
        sign = _one_of(points, SYMBOLS)

        def in_texts(mask: np.ndarray) -> np.ndarray:
            return per_text(n, chunk.owner(np.flatnonzero(mask)))

        # three words in a row, found twice or more in their text
        windows = window_hashes(words, 3)
        same_text = owner[2:] == owner[: len(windows)] if len(windows) else np.zeros(0, bool)
        at = np.flatnonzero(same_text)
        again = at[repeated(owner[at], windows[at])[1]]
        covered = np.zeros(len(words), bool)
        for k in range(3):
            covered[again + k] = True

        # whole lines that hold a word, equal to an earlier one of their text
        breaks = np.flatnonzero(points == 10)
        line_start = np.concatenate(([0], breaks[:-1] + 1)) if len(breaks) else breaks
        word_before = np.concatenate(([0], np.cumsum(inside)))
        full = word_before[breaks] > word_before[line_start]
        line_start, breaks = line_start[full], breaks[full]
        line_owner = chunk.owner(line_start)
        dup = repeated(line_owner, chunk.span_hashes(sums, line_start, breaks))[0]

        stutter = np.zeros(len(words), bool)
        stutter[1:] = (words[1:] == words[:-1]) & (owner[1:] == owner[:-1])
        # a sign within it, or capitals after the first letter, make a word odd
        signs = np.concatenate(([0], np.cumsum(inside & ~plain)))
        capitals = np.concatenate(([0], np.cumsum(upper)))
        odd = (signs[end] > signs[start]) | (capitals[end] - capitals[start + 1] > 1)
        made["n_words"].append(per_text(n, owner))
        made["word_chars"].append(in_texts(inside))
        made["n_symbols"].append(in_texts(sign))
        made["n_dup_lines"].append(per_text(n, line_owner[dup]))
        made["n_repeat_words"].append(per_text(n, owner[covered]))
        made["n_lines"].append(per_text(n, line_owner))
        made["n_odd_chars"].append(in_texts(sign | upper | (points == ord("!"))))
        made["n_odd_words"].append(per_text(n, owner[odd]))
        made["n_stutter"].append(per_text(n, owner[stutter]))
    return {c: np.concatenate(v) if v else np.zeros(0, np.int64) for c, v in made.items()}


def _counted(docs: DataFrame) -> DataFrame:
    """Whole input rows as ``row`` beside the counts and the vote pattern as a number."""
    rows = docs.select(F.struct("*").alias("row"), F.col("text").alias("text"))
    counts = [T.StructField(c, T.LongType()) for c in COUNTS]
    schema = T.StructType([rows.schema["row"], *counts])
    counted = rows.mapInArrow(mapped(count_texts, ("row",)), schema)
    pattern = F.lit(0)
    for vote in rules().values():
        pattern = pattern * 3 + (vote + 1)
    return counted.withColumn("pattern", pattern)


def votes_of(pattern: np.ndarray) -> np.ndarray:
    """Votes plus one (0 bad, 1 silent, 2 good) of each rule, for pattern numbers."""
    k = len(rules())
    return np.stack([pattern // 3 ** (k - 1 - j) % 3 for j in range(k)], axis=1)


def fit(pattern: np.ndarray, count: np.ndarray, rounds: int = 200) -> np.ndarray:
    """Posterior probability of good for each pattern, by expectation-maximisation.

    Every rule has its own chances of each vote on good and on bad texts. They start
    from, and with few texts stay near, a rule that is right more often than wrong.
    """
    votes = votes_of(pattern)
    # chances of bad, silent, good: on bad texts a single rule often sees nothing wrong
    start = np.array([[0.30, 0.35, 0.35], [0.04, 0.36, 0.60]])
    theta = np.repeat(start[:, None, :], votes.shape[1], axis=1)
    prior, strength, total = 0.8, 10.0, max(1.0, float(count.sum()))
    one_hot = np.eye(3)[votes]
    good = np.zeros(len(pattern))
    for _ in range(rounds):
        odds = np.log(prior / (1 - prior)) + np.einsum(
            "pkv,kv->p", one_hot, np.log(theta[1]) - np.log(theta[0])
        )
        before, good = good, 1 / (1 + np.exp(-np.clip(odds, -700, 700)))
        if np.abs(good - before).max(initial=0) < 1e-9:
            break
        for c, share in enumerate((1 - good, good)):
            seen = np.einsum("p,pkv->kv", share * count, one_hot) + strength * start[c]
            theta[c] = seen / seen.sum(axis=1, keepdims=True)
        prior = (float(good @ count) + strength * 0.8) / (total + strength)
    return good


def with_verdicts(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """``row`` (the input row), the counts, ``quality`` (posterior), ``base_failed`` and ``kept``.

    Reads the texts twice, once to count the vote patterns and once to apply
    the posteriors, so no text is shuffled.
    """
    spark = docs.sparkSession
    tally = _counted(docs).groupBy("pattern").agg(F.count(F.lit(1)).alias("n")).collect()
    tally.sort(key=lambda r: r.pattern)
    pattern = np.array([r.pattern for r in tally], np.int64)
    good = fit(pattern, np.array([r.n for r in tally], float))
    known = spark.createDataFrame(
        list(zip(pattern.tolist(), good.tolist(), strict=True)), "pattern int, quality double"
    )
    words, again = F.col("n_words"), F.col("n_repeat_words")
    failed = (words < MIN_WORDS) | (100 * again > MAX_REPEAT_PERCENT * words)
    # at most 3 ** len(rules) rows
    judged = _counted(docs).join(F.broadcast(known), "pattern", "left")
    return judged.withColumn("base_failed", failed).withColumn(
        "kept", ~F.col("base_failed") & (F.coalesce(F.col("quality"), F.lit(0.0)) >= threshold)
    )


def quality_rules(docs: DataFrame) -> DataFrame:
    """Counts and verdict by document."""
    return with_verdicts(docs).select(
        F.col("row.doc_id").alias("doc_id"),
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "quality",
    )


def keep_good(docs: DataFrame) -> DataFrame:
    """The input rows the rules keep, unchanged."""
    return with_verdicts(docs).filter("kept").select("row.*")
