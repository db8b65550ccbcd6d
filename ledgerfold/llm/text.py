"""Texts of an Arrow batch as numpy arrays: code points, words and their hashes.

All texts of a chunk lie in one array, each followed by a line feed, so one
numpy call works on many short texts and a single long text alike.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession

# Code points per chunk; one longer text is a chunk of its own.
CHUNK = 1 << 18
# Rows computed together; bounds the Python strings and arrays in memory.
ROWS = 1024
_BASE = 0x9E3779B97F4A7C15


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


@lru_cache(maxsize=2)
def _powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    n, inverse = 1 << bits, pow(_BASE, -1, 1 << 64)
    made = []
    for base in (_BASE, inverse):
        steps = np.full(n, base, np.uint64)
        steps[0] = 1
        made.append(np.cumprod(steps, dtype=np.uint64))
    return made[0], made[1]


@dataclass(frozen=True)
class Chunk:
    """``points`` of all texts; text ``i`` is ``points[first[i]:last[i]]``."""

    points: np.ndarray
    first: np.ndarray
    last: np.ndarray

    def prefix_hashes(self, values: np.ndarray | None = None) -> np.ndarray:
        v = (self.points if values is None else values).astype(np.uint64) + np.uint64(0x51ED27)
        power, _ = _powers(max(18, int(len(v)).bit_length()))
        sums = np.zeros(len(v) + 1, np.uint64)
        np.cumsum(mixed(v) * power[: len(v)], out=sums[1:])
        return sums

    @staticmethod
    def span_hashes(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """64-bit hashes of spans, equal for equal content wherever it stands."""
        _, inverse = _powers(max(18, int(len(sums) - 1).bit_length()))
        return mixed((sums[end] - sums[start]) * inverse[start] + (end - start).astype(np.uint64))

    def runs(self, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the stretches where ``inside`` holds; none spans two texts."""
        edge = np.diff(inside.astype(np.int8), prepend=np.int8(0), append=np.int8(0))
        return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)

    def owner(self, position: np.ndarray) -> np.ndarray:
        """Number of the text that each position lies in."""
        return np.searchsorted(self.first, position, "right") - 1


def chunked(texts: list[str | None]) -> Iterator[tuple[slice, Chunk]]:
    """The texts in chunks of about ``CHUNK`` code points; null reads as empty."""
    start = size = 0
    for i, text in enumerate(texts):
        n = len(text or "") + 1
        if i > start and size + n > CHUNK:
            yield slice(start, i), _chunk(texts[start:i])
            start, size = i, 0
        size += n
    if start < len(texts):
        yield slice(start, len(texts)), _chunk(texts[start:])


def _chunk(texts: list[str | None]) -> Chunk:
    whole = "".join([(t or "") + "\n" for t in texts])
    points = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), "<u4")
    ends = np.cumsum([len(t or "") + 1 for t in texts])
    return Chunk(points, np.concatenate(([0], ends[:-1])), ends - 1)


def is_space(points: np.ndarray) -> np.ndarray:
    return (points == 0x20) | ((points >= 0x09) & (points <= 0x0D))


def per_text(count: int, owner: np.ndarray, weight: np.ndarray | None = None) -> np.ndarray:
    """Occurrences, or sums of weights, by text number."""
    sums = np.bincount(owner, weights=weight, minlength=count)
    return sums if weight is not None and weight.dtype.kind == "f" else sums.astype(np.int64)


def repeated(owner: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each item whether an equal value of the same owner came earlier, and whether one
    comes at all (earlier or later). Values are hashes, items stand in text order."""
    n = len(value)
    if not n:
        return np.zeros(0, bool), np.zeros(0, bool)
    key = mixed(value + owner.astype(np.uint64) * np.uint64(_BASE))
    order = np.argsort(key, kind="stable")
    same = key[order[1:]] == key[order[:-1]]
    earlier, any_other = np.zeros(n, bool), np.zeros(n, bool)
    earlier[order[1:]] = same
    any_other[order[1:]] |= same
    any_other[order[:-1]] |= same
    return earlier, any_other


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all stretches of ``size`` consecutive words (within one owner or not)."""
    n = max(0, len(words) - size + 1)
    h = np.zeros(n, np.uint64)
    for k in range(size):
        h = mixed(h * np.uint64(_BASE) + words[k : k + n])
    return h


def small_batches(spark: SparkSession) -> None:
    """Let Spark pass ``ROWS`` rows at once to Python, not 10,000: rows hold whole texts.

    A number that somebody has set already stays.
    """
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(setting) == "10000":
        spark.conf.set(setting, str(ROWS))


def listed(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    """Consecutive values as one list per count."""
    offsets = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def mapped(
    compute: Callable[[list[str | None]], dict[str, np.ndarray | list | pa.Array]],
    keep: tuple[str, ...],
    text: str = "text",
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function for ``mapInArrow`` that adds columns computed from the text column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                made = compute(batch.column(text).to_pylist())
                new = [v if isinstance(v, pa.Array) else pa.array(v) for v in made.values()]
                columns = [batch.column(c) for c in keep] + new
                yield pa.RecordBatch.from_arrays(columns, [*keep, *made])

    return run
