"""Byte-level BPE encoding and decoding by corpus-level merge replay.

The distinct words of a block of texts are laid out as one list of symbols. An
inverted index tells for every rank at which positions its pair stands; ranks
are replayed from the lowest, each at all its positions at once, and only the
neighbours of merged symbols are looked up again. Blocks are bounded, so memory
is too; a single longer text is a block of its own.

Null texts read as empty: no tokens. Repeated rows are encoded alike; an empty
table gives no rows.
"""

from __future__ import annotations

import base64
from collections import defaultdict
from functools import lru_cache, partial
from hashlib import sha256
from heapq import heapify, heappop, heappush

import numpy as np
import regex
from pyspark.sql import DataFrame

from ledgerfold.llm.text import mapped

# Code points of text encoded together, and encoded words a task remembers.
BLOCK, REMEMBERED = 1 << 20, 100_000


class Ranks:
    """Tokens by rank; two adjacent tokens merge when their joined bytes are a token."""

    def __init__(self, path: str, pattern: str) -> None:
        with open(path, "rb") as file:
            lines = [line.split() for line in file if line.strip()]
        self.rank = {base64.b64decode(token): int(rank) for token, rank in lines}
        size = max(self.rank.values()) + 1
        self.token = [b""] * size
        for token, rank in self.rank.items():
            self.token[rank] = token
        self.single = np.array([self.rank[bytes([b])] for b in range(256)], np.int64)
        self.width = size
        pairs = [
            (left * size + right, rank)
            for token, rank in self.rank.items()
            for cut in range(1, len(token))
            if (left := self.rank.get(token[:cut])) is not None
            and (right := self.rank.get(token[cut:])) is not None
        ]
        pairs.sort()
        self.pair = np.array([p for p, _ in pairs] + [np.iinfo(np.int64).max], np.int64)
        self.made = np.array([r for _, r in pairs] + [-1], np.int64)
        self.pieces = regex.compile(pattern).findall
        self.place: dict[str, int] = {}
        self.ids: np.ndarray = np.zeros(0, np.int64)
        self.first: np.ndarray = np.zeros(1, np.int64)

    def joined(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each joined pair, -1 where it is no token or a side is missing (-1)."""
        key = left.astype(np.int64) * self.width + right
        at = np.searchsorted(self.pair, key)
        return np.where((self.pair[at] == key) & (left >= 0) & (right >= 0), self.made[at], -1)

    def replay(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all words, one after another, and where each word begins (and the end)."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        start = np.cumsum(sizes + 1) - sizes  # one gap before each word and at the end
        total = int(sizes.sum()) + len(words) + 1
        symbol = np.full(total, -1, np.int32)
        data = np.frombuffer(b"".join(words), np.uint8)
        word_of = np.repeat(np.arange(len(words)), sizes)
        place = np.arange(len(data)) + word_of + 1
        symbol[place] = self.single[data]
        owner = np.full(total, -1, np.int32)
        owner[place] = word_of
        after = np.arange(1, total + 1, dtype=np.int32)
        before = np.arange(-1, total - 1, dtype=np.int32)
        rank = np.full(total, -1, np.int32)  # of the pair that begins here
        rank[:-1] = self.joined(symbol[:-1], symbol[1:])
        index: dict[int, list[np.ndarray]] = defaultdict(list)

        def note(positions: np.ndarray) -> list[int]:
            """Put positions into the index by rank; gives the ranks."""
            order = positions[np.argsort(rank[positions], kind="stable")]
            ranks, cut = np.unique(rank[order], return_index=True)
            for r, part in zip(ranks.tolist(), np.split(order, cut[1:]), strict=True):
                index[r].append(part)
            return ranks.tolist()

        heap = note(np.flatnonzero(rank >= 0)) if total > 1 else []
        heapify(heap)
        slow: set[int] = set()
        while heap:
            r = heappop(heap)
            parts = index.pop(r, None)
            if parts is None:
                continue
            at = parts[0] if len(parts) == 1 else np.unique(np.concatenate(parts))
            at = at[rank[at] == r]
            if not len(at):
                continue
            if len(at) > 1:
                # in a run of overlapping pairs every second one stands
                over = np.concatenate(([False], at[1:] == after[at[:-1]]))
                if over.any():
                    head = np.maximum.accumulate(np.where(over, 0, np.arange(len(at))))
                    at = at[(np.arange(len(at)) - head) % 2 == 0]
            right = after[at]
            beyond = after[right]
            symbol[at], symbol[right] = r, -1
            after[at], before[beyond] = beyond, at
            rank[right] = -1
            # only the two pairs beside each merged symbol change
            prior = before[at]
            rank[at] = self.joined(symbol[at], symbol[after[at]])
            rank[prior] = self.joined(symbol[prior], symbol[at])
            touched = np.concatenate((at, prior))
            touched = touched[rank[touched] >= 0]
            if len(touched):
                lower = touched[rank[touched] <= r]
                if len(lower):
                    # a new pair comes before what is left of this rank: within a word
                    # with several places their order matters, so it is done one by one
                    many = np.flatnonzero(np.bincount(owner[at], minlength=1) > 1)
                    slow.update(np.intersect1d(owner[lower], many).tolist())
                for found in note(np.unique(touched)):
                    heappush(heap, found)
        left = np.flatnonzero(symbol >= 0)
        ids, counts = symbol[left], np.bincount(owner[left], minlength=len(words))
        first = np.concatenate(([0], np.cumsum(counts)))
        if slow:
            parts = np.split(ids, first[1:-1])
            for w in slow:
                parts[w] = np.array(self.one_by_one(words[w]), np.int64)
            ids = np.concatenate(parts)
            first = np.concatenate(([0], np.cumsum([len(p) for p in parts])))
        return ids, first

    def one_by_one(self, word: bytes) -> list[int]:
        """Tokens of one word, merging its leftmost lowest pair each time."""
        symbols = [int(self.single[b]) for b in word]
        n = len(symbols)
        after, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n

        def pair(i: int) -> int | None:
            j = after[i]
            if j >= n:
                return None
            return self.rank.get(self.token[symbols[i]] + self.token[symbols[j]])

        heap = [(r, i) for i in range(n) if (r := pair(i)) is not None]
        heapify(heap)
        while heap:
            r, i = heappop(heap)
            if not alive[i] or pair(i) != r:
                continue
            j = after[i]
            symbols[i], alive[j], after[i] = r, False, after[j]
            if after[j] < n:
                before[after[j]] = i
            for k in (i, before[i]):
                if k >= 0 and (found := pair(k)) is not None:
                    heappush(heap, (found, k))
        return [s for s, a in zip(symbols, alive, strict=True) if a]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Token ids of each text."""
        if len(self.place) > REMEMBERED:
            self.place, self.ids, self.first = {}, np.zeros(0, np.int64), np.zeros(1, np.int64)
        place = self.place
        spoken = [self.pieces(t) for t in texts]
        fresh = list(dict.fromkeys(p for pieces in spoken for p in pieces if p not in place))
        if fresh:
            ids, first = self.replay([p.encode("utf-8") for p in fresh])
            place.update(zip(fresh, range(len(place), len(place) + len(fresh)), strict=True))
            self.first = np.concatenate((self.first, first[1:] + self.first[-1]))
            self.ids = np.concatenate((self.ids, ids))
        made = []
        for pieces in spoken:
            at = np.fromiter(map(place.__getitem__, pieces), np.int64, len(pieces))
            begin, count = self.first[at], self.first[at + 1] - self.first[at]
            ends = np.cumsum(count)
            within = np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - count, count)
            made.append(self.ids[np.repeat(begin, count) + within])
        return made

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.token.__getitem__, ids.tolist()))


@lru_cache(maxsize=2)
def ranks(path: str, pattern: str) -> Ranks:
    return Ranks(path, pattern)


def _blocks(texts: list[str | None]) -> list[list[str]]:
    made, size = [[]], 0
    for text in texts:
        if made[-1] and size + len(text or "") > BLOCK:
            made.append([])
            size = 0
        made[-1].append(text or "")
        size += len(text or "")
    return made if texts else []


def encode_texts(texts: list[str | None], path: str, pattern: str) -> dict[str, list]:
    """Ids as little-endian unsigned 32-bit integers."""
    table = ranks(path, pattern)
    coded = [ids for block in _blocks(texts) for ids in table.encode(block)]
    return {"ids": [ids.astype("<u4").tobytes() for ids in coded]}


def decode_ids(packed: list[bytes | None], path: str, pattern: str) -> dict[str, list]:
    table = ranks(path, pattern)
    return {"text": [table.decode(np.frombuffer(ids or b"", "<u4")) for ids in packed]}


def digests(texts: list[str | None], path: str, pattern: str) -> dict[str, list]:
    """Number and digest of the ids, and digest of the bytes they decode to."""
    packed = encode_texts(texts, path, pattern)["ids"]
    decoded = decode_ids(packed, path, pattern)["text"]
    return {
        "n_tokens": np.array([len(p) // 4 for p in packed], np.int64),
        "ids_sha256": [sha256(p).hexdigest() for p in packed],
        "decoded_sha256": [sha256(t).hexdigest() for t in decoded],
    }


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id`` and ``ids`` (packed little-endian unsigned 32-bit integers)."""
    code = mapped(partial(encode_texts, path=path, pattern=pattern), ("doc_id",))
    return docs.select("doc_id", "text").mapInArrow(code, "doc_id bigint, ids binary")


def decode(coded: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id`` and ``text`` (the decoded bytes) of packed ids."""
    code = mapped(partial(decode_ids, path=path, pattern=pattern), ("doc_id",), "ids")
    return coded.select("doc_id", "ids").mapInArrow(code, "doc_id bigint, text binary")


def encoded_digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``ids_sha256`` and ``decoded_sha256``."""
    code = mapped(partial(digests, path=path, pattern=pattern), ("doc_id",))
    return docs.select("doc_id", "text").mapInArrow(
        code, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    )
