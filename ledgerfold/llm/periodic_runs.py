"""Stretches of words that repeat with a period, found with a recompression grammar.

The words of many texts stand in one sequence, a separator of its own after each text.
Block compression names every stretch of one symbol, pair compression names the
pairs of a symbol of one half of the alphabet followed by one of the other half; in turn,
until a text has but a few symbols left. Since names depend on content alone,
two places have an equal stretch ahead of them as long as the symbols that cover
it are equal, so an extension is found by going up the levels while symbols agree
and down again where they differ (Jez 2015, I 2017).

A run of period ``q`` and length ``m`` holds ``m - q`` neighbouring places whose word comes again
``q`` words later. A grid of that step over each text therefore meets it; all grids
together have about ``n log n`` places. Where the words at a grid place and ``q`` later agree, two
extensions give the exact run. Of runs with the same ends the smallest period stays.

* A null or empty text has no words, no run and an empty collapsed text.
* Repeated rows, or rows without an id, are rows like any other; the table's other columns
  are not looked at. An empty table gives no rows.
* A text however long is worked on as a whole; grid places are taken in portions.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerfold.llm.text import mixed
from ledgerfold.llm.wordlists import Numbers, flat, sizes, slices, word_lists

MIN_LENGTH, MIN_REPEATS = 24, 3
# Bytes of text whose words stand in one sequence, and grid places looked at together.
_TEXT, _PLACES = 1 << 19, 1 << 18
# Symbols of a text at which compression may stop; the rest is compared one by one.
_WIDTH = 4

RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


@dataclass(frozen=True)
class Level:
    """Symbols in order, and how they are grouped into those of the next level.

    ``up`` is the place of the symbol above each one, ``first`` the place of the first
    symbol below each one of the next level, with the end behind the last.
    """

    symbols: np.ndarray
    up: np.ndarray
    first: np.ndarray
    blocks: bool


@dataclass(frozen=True)
class Grammar:
    levels: list[Level]
    top: np.ndarray

    def extension(self, p: np.ndarray, q: np.ndarray, step: int) -> np.ndarray:
        """How many symbols agree from places ``p`` and ``q`` on; with ``step`` -1, backwards."""
        start, p, q = p, p.copy(), q.copy()
        halt = np.full(len(p), len(self.levels))
        alive = np.arange(len(p))
        for depth, level in enumerate(self.levels):
            same = level.symbols[p[alive]] == level.symbols[q[alive]]
            halt[alive[~same]] = depth
            alive = alive[same]
            if not len(alive):
                break
            a, b = p[alive], q[alive]
            rest_a, whole_a = _rest(level, a, step)
            rest_b, whole_b = _rest(level, b, step)
            # within a group on one side: first leave the group on both
            within = (rest_a != whole_a) | (rest_b != whole_b)
            by = np.where(within, np.minimum(rest_a, rest_b), 0) * step
            a, b = a + by, b + by
            p[alive], q[alive] = a, b
            # blocks of which unequal stretches are left part here
            part = within & (rest_a != rest_b)
            halt[alive[part]] = depth
            alive = alive[~part]
            p[alive], q[alive] = level.up[a[~part]], level.up[b[~part]]
        while len(alive):
            alive = alive[self.top[p[alive]] == self.top[q[alive]]]
            p[alive] += step
            q[alive] += step
        for depth in range(len(self.levels) - 1, -1, -1):
            level, down = self.levels[depth], np.flatnonzero(halt > depth)
            first, behind = level.first[:-1], level.first[1:]
            a, b = p[down], q[down]
            size = np.minimum(behind[a] - first[a], behind[b] - first[b]) if level.blocks else 1
            a, b = (first[a], first[b]) if step > 0 else (behind[a] - 1, behind[b] - 1)
            by = np.where(level.symbols[a] == level.symbols[b], size, 0) * step
            p[down], q[down] = a + by, b + by
        return np.abs(p - start)


def _rest(level: Level, place: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
    """Symbols from a place to the end of its group, and of the group as a whole."""
    first, behind = level.first[level.up[place]], level.first[level.up[place] + 1]
    return (behind - place if step > 0 else place - first + 1), behind - first


def _grouped(symbols: np.ndarray, starts: np.ndarray, blocks: bool) -> Level:
    marks = np.zeros(len(symbols), np.int64)
    marks[starts] = 1
    return Level(symbols, np.cumsum(marks) - 1, np.append(starts, len(symbols)), blocks)


def recompressed(symbols: np.ndarray, fixed: int, width: int = _WIDTH) -> Grammar:
    """The grammar of a sequence; symbols below ``fixed`` are separators, each one used once."""
    levels: list[Level] = []
    fresh, turn = int(symbols.max(initial=0)) + 1, 0
    while True:
        starts = np.flatnonzero(np.append(True, symbols[1:] != symbols[:-1])[: len(symbols)])
        if len(starts) < len(symbols):
            levels.append(_grouped(symbols, starts, True))
            size = np.diff(levels[-1].first)
            symbols, long = symbols[starts], np.flatnonzero(size > 1)
            values, name = np.unique(
                symbols[long] * (int(size.max()) + 1) + size[long], return_inverse=True
            )
            symbols[long] = fresh + name
            fresh += len(values)
        free = symbols >= fixed
        if np.diff(np.flatnonzero(~free)).max(initial=0) <= width + 1:
            return Grammar(levels, symbols)
        side = mixed(symbols.astype(np.uint64) + np.uint64(turn << 40)) & np.uint64(1) == 1
        turn += 1
        inner = free[:-1] & free[1:]
        pairs = max(
            (inner & side[:-1] & ~side[1:], inner & ~side[:-1] & side[1:]), key=np.count_nonzero
        )
        at = np.flatnonzero(pairs)
        if not len(at):
            continue
        single = np.ones(len(symbols), bool)
        single[at + 1] = False
        starts = np.flatnonzero(single)
        levels.append(_grouped(symbols, starts, False))
        key = symbols[at] * fresh + symbols[at + 1]
        values, name = np.unique(key, return_inverse=True)
        symbols = symbols.copy()
        symbols[at] = fresh + name
        symbols = symbols[starts]
        fresh += len(values)


def _grid(n: np.ndarray, shortest: int, repeats: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Portions of (text, period, place): for every period a grid over the text."""
    most = np.where(n >= shortest, n // repeats, 0)
    total = np.cumsum(most)
    start = 0
    while start < (total[-1] if len(total) else 0):
        stop = min(int(total[-1]), start + _PLACES // 4)
        pair = np.arange(start, stop)
        text = np.searchsorted(total, pair, "right")
        period = pair - (total[text] - most[text]) + 1
        step = np.maximum(shortest - period, (repeats - 1) * period)
        places = (n[text] - period + step - 1) // step
        ends = np.cumsum(places)
        here = 0
        while here < len(pair):
            before = int(ends[here - 1]) if here else 0
            there = max(here + 1, int(np.searchsorted(ends, before + _PLACES, "right")))
            taken = places[here:there]
            row = np.repeat(np.arange(here, there), taken)
            turn = np.arange(len(row)) - np.repeat(ends[here:there] - taken - before, taken)
            yield text[row], period[row], turn * step[row]
            here = there
        start = stop


def runs_of(
    words: np.ndarray, n: np.ndarray, shortest: int = MIN_LENGTH, repeats: int = MIN_REPEATS
) -> np.ndarray:
    """Rows (text, start, length, period) in this order, of texts with ``n`` words each.

    A run keeps its smallest period as far as it goes, has ``shortest`` words and ``repeats``
    periods at least.
    """
    texts = len(n)
    # a separator before the first text and after each one
    first = 1 + np.cumsum(n + 1) - (n + 1)
    symbols = np.empty(len(words) + texts + 1, np.int64)
    marks = np.append(0, first + n)
    symbols[marks] = np.arange(texts + 1)
    inside = np.ones(len(symbols), bool)
    inside[marks] = False
    symbols[inside] = words + texts + 1
    grammar, found = None, []
    for text, period, place in _grid(n, shortest, repeats):
        at = first[text] + place
        meet = np.flatnonzero(symbols[at] == symbols[at + period])
        if not len(meet):
            continue
        grammar = grammar or recompressed(symbols, texts + 1)
        text, period, at = text[meet], period[meet], at[meet]
        ahead = grammar.extension(at, at + period, 1)
        behind = grammar.extension(at - 1, at + period - 1, -1)
        length = ahead + behind + period
        long = length >= np.maximum(shortest, repeats * period)
        rows = np.stack([text, at - behind - first[text], length, period], axis=1)[long]
        found.append(np.unique(rows, axis=0))
    rows = np.unique(np.concatenate([np.zeros((0, 4), np.int64), *found]), axis=0)
    # of equal ends the first has the smallest period
    again = np.zeros(len(rows), bool)
    again[1:] = (rows[1:, :3] == rows[:-1, :3]).all(axis=1)
    rows = rows[~again]
    return rows[np.lexsort((rows[:, 3], rows[:, 1], rows[:, 0]))]


def _left(n: int, runs: np.ndarray) -> np.ndarray:
    """Which words stay: those that no run holds after its first period."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, runs[:, 1] + runs[:, 3], 1)
    np.add.at(edge, runs[:, 1] + runs[:, 2], -1)
    return np.cumsum(edge[:-1]) == 0


def _found(shortest: int, repeats: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", _TEXT):
            lists = word_lists(batch.column("text"))
            n = sizes(lists)
            rows = runs_of(Numbers()(flat(lists)), n, shortest, repeats)
            ends = np.searchsorted(rows[:, 0], np.arange(len(lists) + 1))
            collapsed = []
            for words, here, there in zip(lists, ends[:-1], ends[1:], strict=True):
                if here < there:
                    left = _left(len(words), rows[here:there])
                    words = [words[i] for i in np.flatnonzero(left)]
                collapsed.append(b" ".join(words))
            fields = [pa.array(rows[:, k]) for k in (1, 2, 3)]
            runs = pa.StructArray.from_arrays(fields, ["start", "length", "period"])
            made = {
                "id": batch.column("id"),
                "n_words": pa.array(n),
                "runs": pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), runs),
                "collapsed": pa.array(collapsed, pa.binary()).cast(pa.string()),
            }
            yield pa.RecordBatch.from_arrays(list(made.values()), list(made))

    return run


def periodic_runs(
    docs: DataFrame,
    text: Column | None = None,
    min_length: int = MIN_LENGTH,
    min_repeats: int = MIN_REPEATS,
) -> DataFrame:
    """``doc_id``, ``n_words``, ``runs`` (by start, then period) and ``collapsed``, the text
    whose runs keep their first period alone, words joined by one space.

    Texts are those of column ``text`` unless another expression is given.
    """
    given = docs.select(
        F.col("doc_id").alias("id"), (F.col("text") if text is None else text).alias("text")
    )
    schema = T.StructType(
        [
            T.StructField("id", given.schema["id"].dataType),
            T.StructField("n_words", T.LongType()),
            T.StructField("runs", T.DataType.fromDDL(RUNS)),
            T.StructField("collapsed", T.StringType()),
        ]
    )
    made = given.mapInArrow(_found(min_length, min_repeats), schema)
    return made.withColumnRenamed("id", "doc_id")


def with_planted_tail() -> Column:
    """The text, of every tenth id (by checksum) with a tail that goes in circles.

    Word ``i`` from ``a`` on is the original word ``a + (i - a) % p``. A null id changes nothing.
    """
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), 0)

    def turned(w: Column) -> Column:
        """The text of the words with the circling tail."""
        n, g = F.size(w).cast("bigint"), F.floor(h / 10)
        a = g % n
        shape = F.struct(a.alias("a"), (1 + F.floor((n - a) / (3 + g % 8))).alias("p"))
        return _bound(
            shape,
            lambda s: F.array_join(
                F.transform(
                    w,
                    lambda x, i: F.when(i < s["a"], x).otherwise(
                        F.get(w, (s["a"] + (i - s["a"]) % s["p"]).cast("int"))
                    ),
                ),
                " ",
            ),
        )

    changed = _bound(words, lambda w: F.when(F.size(w) > 0, turned(w)))
    return F.when(h % 10 == 0, F.coalesce(changed, F.col("text"))).otherwise(F.col("text"))


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, though named many times."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def runs_report(docs: DataFrame) -> DataFrame:
    """Per document the number of runs, its run of greatest exponent, and digests."""
    found = periodic_runs(docs, with_planted_tail())
    # exponents are compared as fractions; the first of equal ones stays
    best = F.expr(
        "aggregate(runs, runs[0], (a, b) -> "
        "IF(b.length * a.period > a.length * b.period, b, a))"
    )
    line = F.transform(
        "runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    )
    text = F.concat(F.array_join(line, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    return found.withColumn("best", F.when(F.size("runs") > 0, best)).select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(text, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
