"""Repeated passages of words by suffix trees, built in groups of prefixes.

A passage is a window of ``WINDOW`` words. Suffixes start at anchors: of the stretches of
``GRAM`` words in a window the one with the smallest hash (the first of equal ones), so equal
windows have the same anchor at the same place, and neighbouring windows share one. An
anchored suffix carries the words of all windows it anchors, some 17 for five or six windows,
which is what makes it cheaper to send than every suffix with its own words.

Suffixes are split by a prefix of variable length, counted from the anchor: one word, or for
prefixes that start more than a share of all suffixes two, three, up to ``GRAM`` words. A group of
prefixes fits into memory and becomes a pair of trees: one of the words from the anchor on, one
of the words before it read backwards, each as the sorted order with its common prefix
lengths. An internal node at depth ``WINDOW - o`` of the first and one at depth ``o`` of the
second together are a passage that starts ``o`` words before its anchors; they repeat where
they have leaves in several documents. Nodes compare words, not hashes.

Most suffixes never enter a tree: a prefix of ``GRAM`` words that one document alone has is a
leaf. Prefixes go to sieves as 32 bits of hash beside an id, and the documents are told which of
theirs others have (a false hit only brings a suffix into a tree in vain).

Copies cost little: what a portion of the input (``_PORTION`` bytes of text) shows to be shared
is sent to the sieve once, and of equal suffixes of a portion only the one of the smallest
id enters a tree, since all windows of the others are repeats already. A passage that a
third of all documents share is thus one leaf for each portion.

* A null text has no words. Text of any length is worked on as a whole.
* A row without id is not smaller than any other and none is smaller than it: nothing of it is
  removed and it removes nothing. Rows of one id do not remove from each other.
* Repeated rows get the same result. Other columns are not looked at; no rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, fields

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerfold.llm.text import mixed
from ledgerfold.llm.wordlists import Numbers, flat, sizes, slices, word_lists
from ledgerfold.session import checkpointed

WINDOW, GRAM = 13, 4
# Stretches of GRAM words in a window: an anchor has at most this many windows.
_REACH = WINDOW - GRAM + 1
# Bytes of text in a portion and in what is split at once, and for each group and sieve.
_PORTION, _SPLIT, _GROUP, _SIEVE = 5 << 20, 1 << 20, 10_000_000, 20_000_000
_CODEC = pa.Codec("zstd", compression_level=3)
_FIELDS = [("doc", np.int64), ("key", np.int64), ("start", np.int32), ("left", np.int8), ("windows", np.int8)]


@dataclass(frozen=True)
class Portion:
    """Words of many texts in one sequence; row ``i`` has ``n[i]`` of them.

    ``shared`` has row number and hash of the prefixes that other documents have as well.
    """

    doc: np.ndarray
    key: np.ndarray
    n: np.ndarray
    words: np.ndarray
    hashes: np.ndarray
    sizes: np.ndarray
    joined: bytes
    shared: np.ndarray


@dataclass(frozen=True)
class Suffixes:
    """Anchors with the stretch of windows that each one has: places in a portion's words."""

    row: np.ndarray
    anchor: np.ndarray
    start: np.ndarray
    windows: np.ndarray

    def those(self, chosen: np.ndarray) -> Suffixes:
        return Suffixes(*[getattr(self, f.name)[chosen] for f in fields(self)])


def portions(batches: Iterator[pa.RecordBatch], most: int = _PORTION) -> Iterator[Portion]:
    """The texts in portions of about ``most`` bytes, rows with the smallest ids first."""
    held, size = [], 0
    for batch in slices(batches, "text", _SPLIT):
        if "prefixes" in batch.schema.names:
            # without a prefix that others have, a document has no repeated passage
            batch = batch.filter(pc.is_valid(batch.column("prefixes")))
        held.append(batch.select([c for c in ("doc", "key", "text", "prefixes") if c in batch.schema.names]))
        size += batch.column("text").nbytes
        if size >= most:
            yield _portion(held)
            held, size = [], 0
    if held:
        yield _portion(held)


def _portion(batches: list[pa.RecordBatch]) -> Portion:
    table = pa.Table.from_batches(batches).sort_by("doc")
    numbers, words, lengths, counts, joined = Numbers(), [], [], [], []
    for batch in table.to_batches(max_chunksize=1024):
        for part in slices(iter([batch]), "text", _SPLIT):
            lists = word_lists(part.column("text"))
            all_words = flat(lists)
            words.append(numbers(all_words))
            lengths.append(sizes(all_words))
            counts.append(sizes(lists))
            joined.append(b" ".join(all_words) + b" " if all_words else b"")
    digests = np.fromiter(
        map(xxhash.xxh3_64_intdigest, numbers.words()), np.uint64, len(numbers)
    )
    each = np.concatenate([*words, np.zeros(0, np.int64)])
    return Portion(
        table.column("doc").to_numpy(),
        table.column("key").to_numpy(),
        np.concatenate([*counts, np.zeros(0, np.int64)]),
        each,
        digests[each] if len(digests) else np.zeros(0, np.uint64),
        np.concatenate([*lengths, np.zeros(0, np.int64)]),
        b"".join(joined),
        _shared(table),
    )


def _shared(table: pa.Table) -> np.ndarray:
    if "prefixes" not in table.column_names:
        return np.zeros(0, np.uint64)
    lists = table.column("prefixes").combine_chunks()
    row = np.repeat(np.arange(len(lists), dtype=np.uint64), np.diff(lists.offsets.to_numpy()))
    first, last = lists.offsets[0].as_py(), lists.offsets[-1].as_py()
    return row << np.uint64(32) | lists.values[first:last].to_numpy().view(np.uint32).astype(np.uint64)


def prefix_hashes(words: np.ndarray, length: int) -> np.ndarray:
    """Hashes of all stretches of one up to ``length`` words, one row for each length."""
    made = [mixed(words)]
    for k in range(1, length):
        made.append(mixed(made[-1][:-1] * np.uint64(0x9E3779B97F4A7C15) + words[k:]))
    n = max(0, len(words) - length + 1)
    return np.stack([m[:n] for m in made])


def suffixes(portion: Portion, grams: np.ndarray) -> Suffixes:
    """The anchors of all windows; ``grams`` are hashes of stretches of ``GRAM`` words."""
    ends = np.cumsum(portion.n)
    total = len(portion.words)
    if total < WINDOW:
        none = np.zeros(0, np.int64)
        return Suffixes(none, none, none, none)
    value, at, reach = grams.copy(), np.arange(len(grams)), 1
    while reach < _REACH:
        step = min(reach, _REACH - reach)
        ahead, ahead_at = value[step:], at[step:]
        value, at = value[:-step], at[:-step]
        less = (ahead < value) | ((ahead == value) & (ahead_at < at))
        value, at = np.where(less, ahead, value), np.where(less, ahead_at, at)
        reach += step
    start = np.arange(total - WINDOW + 1)
    row = np.repeat(np.arange(len(portion.n)), portion.n)
    inside = start + WINDOW <= ends[row[start]]
    start, at, row = start[inside], at[inside], row[start[inside]]
    new = np.ones(len(start), bool)
    new[1:] = (at[1:] != at[:-1]) | (row[1:] != row[:-1])
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(start)))
    return Suffixes(row[first], at[first], start[first], count)


def _prefixes(groups: int, sieves: int):
    """For ``mapInArrow``: what a portion knows of the prefixes of its suffixes.

    Prefixes of ``GRAM`` words with the id of their document go to a sieve; one that several
    documents of the portion have is sent once, and its documents are told at once.
    Shorter ones that start often are counted: one with a share above 1 / ``groups`` of all
    suffixes is counted with half of that share at least.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for portion in portions(batches):
            hashes = prefix_hashes(portion.hashes, GRAM)
            found = suffixes(portion, hashes[-1])
            if not len(found.anchor):
                continue
            rows: list[tuple] = [(0, len(found.anchor), None, None, -1, 0)]
            for length in range(GRAM - 1):
                value, n = np.unique(hashes[length][found.anchor], return_counts=True)
                often = n * 2 * groups >= len(found.anchor)
                rows += [
                    (p % sieves, n, None, None, length, p)
                    for p, n in zip(value[often].view(np.int64).tolist(), n[often].tolist(), strict=True)
                ]
            pair = np.stack([hashes[-1][found.anchor], portion.doc[found.row].view(np.uint64)])
            pair = np.unique(pair, axis=1)
            same = np.append(False, pair[0, 1:] == pair[0, :-1])
            shared = same | np.append(same[1:], False)
            told = pair[:, shared]
            if told.shape[1]:
                any_sieve = int(told[0, 0] % np.uint64(sieves))
                rows.append((any_sieve, told.shape[1], *_squeezed(told[0], told[1]), None, None))
            once, shared = pair[:, ~same], shared[~same]
            sieve = mixed(once[0]) % np.uint64(sieves)
            order = np.lexsort((once[1], sieve))
            values, starts = np.unique(sieve[order], return_index=True)
            for value, at in zip(values.tolist(), np.split(order, starts[1:]), strict=True):
                rows.append((value, len(at), *_squeezed(once[0, at], once[1, at], shared[at]), None, None))
            columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _SENT_TYPES, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, _SENT_NAMES)

    return run


_SENT = "sieve bigint, n bigint, packed binary, shared boolean, length int, prefix bigint"
_SENT_NAMES = ["sieve", "n", "packed", "shared", "length", "prefix"]
_SENT_TYPES = [pa.int64(), pa.int64(), pa.binary(), pa.bool_(), pa.int32(), pa.int64()]
_TOLD = "doc bigint, prefix int, length int, n bigint"


def _squeezed(prefix: np.ndarray, doc: np.ndarray, shared: np.ndarray | None = None) -> tuple[bytes, bool]:
    """Prefixes (32 bits of each hash do) and differences of ids, compressed."""
    steps = np.diff(doc.view(np.int64), prepend=np.int64(0))
    parts = [steps.tobytes(), prefix.astype(np.uint32).tobytes()]
    if shared is not None:
        parts.append(shared.tobytes())
    return bytes(_CODEC.compress(b"".join(parts))), shared is not None


def _sieved(table: pa.Table) -> pa.Table:
    """For each document those of its prefixes that others have too; sums of the counts."""
    sums = table.filter(pc.is_valid(table["length"])).group_by(["length", "prefix"]).aggregate([("n", "sum")])
    counted = pa.table(
        [sums["prefix"], pa.nulls(sums.num_rows, pa.int32()), sums["length"], sums["n_sum"]],
        ["doc", "prefix", "length", "n"],
    )
    docs, prefixes, groups, marks = [], [], [], []
    rest = table.filter(pc.is_valid(table["packed"]))
    for n, packed, asked in zip(*[rest[c].to_pylist() for c in ("n", "packed", "shared")], strict=True):
        raw = _CODEC.decompress(packed, n * (13 if asked else 12), asbytes=True)
        docs.append(np.cumsum(np.frombuffer(raw, np.int64, n)))
        prefixes.append(np.frombuffer(raw, np.uint32, n, 8 * n))
        groups.append(np.full(n, asked))
        marks.append(np.frombuffer(raw, np.bool_, n, 12 * n) if asked else np.ones(n, bool))
    if not docs:
        return counted
    doc, prefix, asked, shared = (np.concatenate(v) for v in (docs, prefixes, groups, marks))
    here = np.flatnonzero(asked)
    _, of, count = np.unique(prefix[here], return_inverse=True, return_counts=True)
    # a prefix that a portion has shared is one of several documents, and they have been told
    several = (count > 1) | (np.bincount(of, shared[here], len(count)) > 0)
    told = np.concatenate([here[several[of] & ~shared[here]], np.flatnonzero(~asked)])
    m = len(told)
    columns = [doc[told], prefix[told].view(np.int32), pa.nulls(m, pa.int32()), pa.nulls(m, pa.int64())]
    return pa.concat_tables([counted, pa.table(columns, ["doc", "prefix", "length", "n"])])


def _split(groups: int, frequent: list[np.ndarray]):
    """For ``mapInArrow``: suffixes by group, and passages that a portion shows to be repeats."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for portion in portions(batches):
            hashes = prefix_hashes(portion.hashes, GRAM)
            found = suffixes(portion, hashes[-1])
            asked = (found.row.astype(np.uint64) << np.uint64(32)) | (
                hashes[-1][found.anchor] & np.uint64(0xFFFFFFFF)
            )
            found = found.those(np.isin(asked, portion.shared))
            if not len(found.anchor):
                continue
            prefix = hashes[0][found.anchor]
            for length in range(GRAM - 1):
                longer = np.isin(prefix, frequent[length])
                if not longer.any():
                    break
                prefix[longer] = hashes[length + 1][found.anchor[longer]]
            yield from _packed(portion, found, (mixed(prefix) % np.uint64(groups)).astype(np.int64))

    return run


def _packed(portion: Portion, found: Suffixes, group: np.ndarray) -> Iterator[pa.RecordBatch]:
    offset = np.concatenate(([0], np.cumsum(portion.sizes + 1)))
    first = np.cumsum(portion.n) - portion.n
    doc, key = portion.doc[found.row], portion.key[found.row]
    left = found.anchor - found.start
    here = found.start - first[found.row]
    stop = offset[found.start + found.windows + WINDOW - 1]
    joined, begin = portion.joined, offset[found.start]
    seen: dict[tuple[bytes, int], int] = {}
    text = [joined[a:b] for a, b in zip(begin.tolist(), stop.tolist(), strict=True)]
    least = np.fromiter(
        map(seen.setdefault, zip(text, left.tolist(), strict=True), doc.tolist()), np.int64, len(text)
    )
    # equal to a suffix of a smaller id in this portion: all its windows are repeats
    known = np.flatnonzero(least < doc)
    sent = np.flatnonzero(least >= doc)
    sent = sent[np.argsort(group[sent], kind="stable")]
    values, starts = np.unique(group[sent], return_index=True)
    rows = []
    for value, places in zip(values.tolist(), np.split(sent, starts[1:]), strict=True):
        parts = (doc, key, here, left, found.windows)
        packed = b"".join(
            [p[places].astype(t).tobytes() for p, (_, t) in zip(parts, _FIELDS, strict=True)]
            + [text[i] for i in places.tolist()]
        )
        rows.append((value, len(places), len(packed), bytes(_CODEC.compress(packed)), None))
    if len(known):
        spans = np.stack([doc, key, here, here + found.windows + WINDOW - 1])[:, known]
        # any group will do; they pass it by
        value = int(mixed(spans[:2, 0].astype(np.uint64)).sum() % np.uint64(1 << 31))
        packed = spans.astype(np.int64).tobytes()
        rows.append((value, len(known), len(packed), bytes(_CODEC.compress(packed)), True))
    columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _PACKED_TYPES, strict=True)]
    yield pa.RecordBatch.from_arrays(columns, ["group", "n", "size", "packed", "known"])


_PACKED = "group bigint, n bigint, size bigint, packed binary, known boolean"
_PACKED_TYPES = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.bool_()]
_SPANS = "doc bigint, key bigint, start bigint, stop bigint"


def names_by_depth(words: np.ndarray) -> np.ndarray:
    """Nodes of a tree over rows of words: for each depth the node that each row goes through.

    Rows are sorted word by word; where neighbours have fewer words in common than the
    depth, another node begins. Row ``d`` of the result holds the nodes at depth ``d``.
    """
    m, depth = words.shape
    order = np.lexsort(words.T[::-1])
    differ = words[order[1:]] != words[order[:-1]]
    common = np.where(differ.any(axis=1), differ.argmax(axis=1), depth) if m else np.zeros(0, int)
    made = np.zeros((depth + 1, m), np.int64)
    for d in range(1, depth + 1):
        made[d, order[1:]] = np.cumsum(common < d)
    return made


def repeats(doc: np.ndarray, left: np.ndarray, windows: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Which windows of each suffix some smaller document has too: a row for each suffix.

    ``words`` has the words of all suffixes one after another.
    """
    m = len(doc)
    n = windows + WINDOW - 1
    last = np.cumsum(n)
    anchor = last - n + left

    def around(step: int, count: int, inside: np.ndarray) -> np.ndarray:
        at = anchor[:, None] + np.arange(count) * step + (0 if step > 0 else -1)
        fits = np.arange(count) < inside[:, None]
        return np.where(fits, words[np.where(fits, at, 0)], -1)

    ahead = names_by_depth(around(1, WINDOW, n - left))
    back = names_by_depth(around(-1, _REACH - 1, left))
    again = np.zeros((m, _REACH), bool)
    for o in range(_REACH):
        # windows that start o words before the anchor
        part = np.flatnonzero((left >= o) & (left - windows < o))
        if not len(part):
            continue
        node = ahead[WINDOW - o, part] * m + back[o, part]
        order = np.argsort(node, kind="stable")
        first = np.flatnonzero(np.append(True, node[order[1:]] != node[order[:-1]]))
        least = np.minimum.reduceat(doc[part][order], first)
        size = np.diff(np.append(first, len(order)))
        inside = np.empty(len(part), np.int64)
        inside[order] = np.repeat(least, size)
        again[part, left[part] - o] = inside < doc[part]
    return again


def _unpacked(table: pa.Table) -> dict[str, np.ndarray]:
    """The suffixes of a group: fields and words as numbers of the group."""
    numbers, made = Numbers(), {name: [] for name in [f for f, _ in _FIELDS] + ["words"]}
    for n, size, packed in zip(*[table.column(c).to_pylist() for c in ("n", "size", "packed")], strict=True):
        raw, at = _CODEC.decompress(packed, size, asbytes=True), 0
        for name, kind in _FIELDS:
            made[name].append(np.frombuffer(raw, kind, n, at).astype(np.int64))
            at += n * np.dtype(kind).itemsize
        made["words"].append(numbers(raw[at:].split()))
    return {name: np.concatenate(parts) for name, parts in made.items()}


def _treed(table: pa.Table) -> pa.Table:
    """Spans of repeated windows in one group."""
    known = table.column("known").is_valid()
    spans = [np.zeros((4, 0), np.int64)]
    for size, packed in zip(*[table.filter(known).column(c).to_pylist() for c in ("size", "packed")], strict=True):
        raw = _CODEC.decompress(packed, size, asbytes=True)
        spans.append(np.frombuffer(raw, np.int64).reshape(4, -1))
    rest = table.filter(pc.invert(known))
    if rest.num_rows:
        of = _unpacked(rest)
        again = repeats(of["doc"], of["left"], of["windows"], of["words"])
        edge = np.diff(again.astype(np.int8), axis=1, prepend=0, append=0)
        item, begin = np.nonzero(edge == 1)
        _, end = np.nonzero(edge == -1)
        start = of["start"][item]
        spans.append(np.stack([of["doc"][item], of["key"][item], start + begin, start + end + WINDOW - 1]))
    columns = np.concatenate(spans, axis=1)
    return pa.table([pa.array(c) for c in columns], ["doc", "key", "start", "stop"])


def _rows(docs: DataFrame) -> DataFrame:
    """Documents with a join key that spreads those without an id."""
    doc = F.col("doc_id").cast("bigint")
    key = F.xxhash64("text")
    apart = F.when(doc.isNull(), key).otherwise(F.lit(0))
    return docs.select("doc_id", "text", doc.alias("doc"), key.alias("key"), apart.alias("apart"))


def _beside(rows: DataFrame, found: DataFrame, name: str) -> DataFrame:
    """All documents, with what was found for their ids. Both joins of a run deal the texts
    in the same way, so they are shuffled once."""
    apart = found.withColumn("apart", F.lit(0).cast("bigint"))
    return rows.join(apart, ["doc", "apart"], "left").select("doc_id", "text", "doc", "key", "apart", name)


def repeated_spans(docs: DataFrame, groups: int | None = None) -> DataFrame:
    """Spans of words (``start`` to ``stop``, end exclusive) that stand in a smaller document too.

    ``doc`` is the id and ``key`` a hash of the text, which together name the row. Spans
    may touch or overlap. ``groups`` is chosen by the size of the texts unless given.
    """
    return _spans(_rows(docs), groups)


def _spans(rows: DataFrame, groups: int | None) -> DataFrame:
    usable = rows.filter("doc IS NOT NULL AND text IS NOT NULL")
    size = usable.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    groups, sieves = groups or 1 + size // _GROUP, 1 + size // _SIEVE
    sent = usable.select("doc", "key", "text").mapInArrow(_prefixes(groups, sieves), _SENT)
    told = checkpointed(sent.groupBy("sieve").applyInArrow(_sieved, _TOLD))
    total = told.filter("length = -1").agg(F.sum("n")).scalar()
    # at most 2 * groups of each length
    often = told.filter((F.col("length") >= 0) & (F.col("n") * (2 * groups) >= total)).collect()
    frequent = [
        np.array([r.doc for r in often if r.length == k], np.int64).view(np.uint64)
        for k in range(GRAM - 1)
    ]
    shared = told.filter("length IS NULL").groupBy("doc").agg(F.collect_list("prefix").alias("prefixes"))
    parts = _beside(rows, shared, "prefixes").mapInArrow(_split(groups, frequent), _PACKED)
    return parts.groupBy("group").applyInArrow(_treed, _SPANS)


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text", _SPLIT):
        lists = word_lists(batch.column("text"))
        spans = batch.column("spans")
        offsets, flat_spans = spans.offsets.to_numpy(), spans.values
        of, start, stop = (flat_spans.field(k).to_numpy() for k in range(3))
        removed, kept = [], []
        for words, key, a, b in zip(
            lists, batch.column("key").to_pylist(), offsets[:-1].tolist(), offsets[1:].tolist(), strict=True
        ):
            n = len(words)
            if a < b:
                mine = np.flatnonzero(of[a:b] == key) + a
                edge = np.zeros(n + 1, np.int64)
                np.add.at(edge, start[mine], 1)
                np.add.at(edge, stop[mine], -1)
                words = [words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0)]
            removed.append(n - len(words))
            kept.append(b" ".join(words))
        made = [
            batch.column("doc_id"),
            pa.array(sizes(lists)),
            pa.array(removed, pa.int64()),
            pa.array(kept, pa.binary()).cast(pa.string()),
        ]
        yield pa.RecordBatch.from_arrays(made, ["doc_id", "n_words", "n_removed", "kept"])


def without_repeats(docs: DataFrame, groups: int | None = None) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_removed`` and ``kept``: the words that no window has
    which a smaller document has too, joined by one space."""
    rows = _rows(docs)
    spans = _spans(rows, groups).groupBy("doc").agg(
        F.collect_list(F.struct("key", "start", "stop")).alias("spans")
    )
    schema = T.StructType(
        [
            T.StructField("doc_id", docs.schema["doc_id"].dataType),
            T.StructField("n_words", T.LongType()),
            T.StructField("n_removed", T.LongType()),
            T.StructField("kept", T.StringType()),
        ]
    )
    return _beside(rows, spans, "spans").mapInArrow(_kept, schema)


def repeats_report(docs: DataFrame) -> DataFrame:
    """Per document the words, those removed, and a digest of the others."""
    return without_repeats(docs).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256")
    )


def repeats_sql() -> str:
    return rf"""
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id,
    coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS words
  FROM documents
), windows AS (
  SELECT r, doc_id, i, array_to_string(words[i:i + {WINDOW - 1}], ' ') AS passage
  FROM (SELECT *, unnest(range(1, greatest(len(words) - {WINDOW - 2}, 1))) AS i FROM texts)
), again AS (
  SELECT r, i FROM (
    SELECT r, doc_id, i, min(doc_id) OVER (PARTITION BY passage) AS least FROM windows)
  WHERE least < doc_id
), gone AS (
  SELECT DISTINCT r, unnest(range(i, i + {WINDOW})) AS i FROM again
), listed AS (
  SELECT r, list(i) AS places FROM gone GROUP BY r
), kept AS (
  SELECT t.r, string_agg(word, ' ' ORDER BY i) AS text
  FROM (SELECT r, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM texts) t
  ANTI JOIN gone g ON g.r = t.r AND g.i = t.i
  GROUP BY t.r
)
SELECT t.doc_id, len(t.words) AS n_words, CAST(coalesce(len(l.places), 0) AS BIGINT) AS n_removed,
  sha256(coalesce(k.text, '')) AS kept_sha256
FROM texts t LEFT JOIN listed l USING (r) LEFT JOIN kept k USING (r)"""
