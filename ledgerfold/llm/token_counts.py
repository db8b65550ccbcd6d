"""Token counts by heap-and-linked-list byte-pair merging; no identifier is emitted.

The symbols of a word form a doubly linked list, its mergeable adjacent pairs a
heap. The pair of the lowest rank (the leftmost of equals) is popped and merged
until none is left: the count is the initial symbols minus the merges. Words
come again and again, so a task keeps counts of the words it has seen.

Null texts read as empty: no bytes, no tokens. Repeated rows are counted alike;
an empty table gives no rows.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from functools import lru_cache, partial
from heapq import heapify, heappop, heappush

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerfold.llm.text import mapped

# Pre-tokens of byte-level BPE, a fixed value.
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
LIMIT = 1024
# Words a task remembers at once; when full it starts anew.
REMEMBERED = 400_000


def byte_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class MergeTable:
    """Ranks of mergeable pairs of symbols, from the JSON file of a tokenizer."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        vocab, merges = told["model"]["vocab"], told["model"]["merges"]
        self.width = 1 << (max(vocab.values(), default=0) + 1).bit_length()
        letters = byte_letters()
        self.symbol = [0] * 256
        for letter, byte in letters.items():
            self.symbol[byte] = vocab.get(letter, -1)
        self.merge: dict[int, tuple[int, int]] = {}
        for rank, pair in enumerate(merges):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            key = vocab[left] * self.width + vocab[right]
            self.merge[key] = (rank, vocab[left + right])
        special = [t["content"] for t in told.get("added_tokens", []) if t["content"]]
        self.special = sorted(special, key=len, reverse=True)
        self.apart = regex.compile("|".join(map(regex.escape, self.special)))
        self.pieces: Callable[[str], list[str]] = regex.compile(PATTERN).findall
        self.counts: dict[str, int] = {}

    def count_word(self, data: bytes) -> int:
        """Tokens of one pre-token."""
        n = len(data)
        if n < 2:
            return n
        width, merge = self.width, self.merge
        symbols = [self.symbol[b] for b in data]
        heap = []
        for i in range(n - 1):
            found = merge.get(symbols[i] * width + symbols[i + 1])
            if found:
                heap.append((found[0], i, found[1], symbols[i], symbols[i + 1]))
        if not heap:
            return n
        heapify(heap)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        tokens = n
        while heap:
            _, i, made, left, right = heappop(heap)
            j = after[i]
            # a pair that an earlier merge changed is out of date
            if symbols[i] != left or j >= n or symbols[j] != right:
                continue
            tokens -= 1
            symbols[i], symbols[j] = made, -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                found = merge.get(made * width + symbols[k])
                if found:
                    heappush(heap, (found[0], i, found[1], made, symbols[k]))
            h = before[i]
            if h >= 0:
                found = merge.get(symbols[h] * width + made)
                if found:
                    heappush(heap, (found[0], h, found[1], symbols[h], made))
        return tokens

    def count(self, text: str) -> int:
        """Tokens of a text; a special string in it is one token."""
        if not any(s in text for s in self.special):
            return self._count(text)
        parts = self.apart.split(text)
        return sum(map(self._count, parts)) + len(parts) - 1

    def _count(self, text: str) -> int:
        known, pieces = self.counts, self.pieces(text)
        try:
            return sum(map(known.__getitem__, pieces))
        except KeyError:
            pass
        if len(known) > REMEMBERED:
            known.clear()
        total = 0
        for piece in pieces:
            n = known.get(piece)
            if n is None:
                n = self.count_word(piece.encode("utf-8"))
                if len(piece) <= 64:
                    known[piece] = n
            total += n
        return total


@lru_cache(maxsize=2)
def merge_table(path: str) -> MergeTable:
    return MergeTable(path)


def count_texts(texts: list[str | None], path: str) -> dict[str, np.ndarray]:
    table = merge_table(path)
    given = [t or "" for t in texts]
    return {
        "n_bytes": np.array([len(t.encode("utf-8")) for t in given], np.int64),
        "n_tokens": np.array([table.count(t) for t in given], np.int64),
    }


def token_counts(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_tokens`` and ``over_limit`` of every document.

    ``path`` names the tokenizer's JSON file, which every executor must have.
    """
    count = mapped(partial(count_texts, path=path), ("doc_id",))
    counted = docs.select("doc_id", "text").mapInArrow(
        count, "doc_id bigint, n_bytes bigint, n_tokens bigint"
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
