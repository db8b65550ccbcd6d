"""Words of texts as numbers: stretches of anything but space and the controls 0x09 to 0x0D.

Splitting UTF-8 bytes at ASCII white space gives exactly these words.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import chain, count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


class Numbers:
    """Words numbered in the order they are first seen."""

    def __init__(self) -> None:
        self._of: defaultdict[bytes, int] = defaultdict(count().__next__)

    def __call__(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self._of.__getitem__, words), np.int64, len(words))

    def __len__(self) -> int:
        return len(self._of)

    def words(self, since: int = 0) -> list[bytes]:
        """All words from number ``since`` on."""
        known = list(self._of)
        return known[since:]


def word_lists(texts: pa.Array) -> list[list[bytes]]:
    """The words of each text; a null has none."""
    return [t.split() if t else [] for t in texts.cast(pa.binary()).to_pylist()]


def sizes(lists: list[list[bytes]]) -> np.ndarray:
    return np.fromiter(map(len, lists), np.int64, len(lists))


def flat(lists: list[list[bytes]]) -> list[bytes]:
    return list(chain.from_iterable(lists))


def slices(batches: Iterator[pa.RecordBatch], text: str, most: int) -> Iterator[pa.RecordBatch]:
    """The rows in batches of about ``most`` bytes of text; one longer text is a batch of its own."""
    for batch in batches:
        lengths = pc.binary_length(batch.column(text).cast(pa.binary()))
        ends = np.cumsum(lengths.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + most, "right")))
            yield batch.slice(start, stop - start)
            start = stop
