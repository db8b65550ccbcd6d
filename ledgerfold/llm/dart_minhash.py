"""Near-duplicate documents by DartMinHash signatures.

A text is the weighted set of its five-word shingles, each weighing its number of
occurrences; similarity is weighted Jaccard (sum of minima over sum of maxima).
Random darts lie in the plane of weight and rank above every shingle, the same in
every text. A text throws away darts above its weights, and each coordinate of
its signature keeps the dart of the lowest rank that hashes to it. Two texts agree
in a coordinate with the probability of their similarity, and a text makes only
some ``k ln k`` darts however long it is. Bands of the signature propose pairs,
all of which are compared exactly before they count.

Texts of fewer than five words are one shingle of all their words. Null texts and
texts without words link with nothing, each row is a class of its own. Equal texts
are one class from the start; repeated rows fall into one class. A class goes by
its smallest id (null where no row has one); an empty table gives no rows.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerfold.llm.graph import components
from ledgerfold.llm.text import (
    chunked,
    is_space,
    listed,
    mapped,
    mixed,
    window_hashes,
)
from ledgerfold.session import checkpointed

SHINGLE, SIMILAR = 5, 0.8
# 32 bands of 4: a pair at 0.8 shares none with a probability of 5e-8.
BANDS, ROWS = 32, 4
_GOLD, _SILVER = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def shingles(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Owner, hash and count of the distinct shingles of each text, by owner and hash."""
    owners, hashes, base = [], [], 0
    for _, chunk in chunked(texts):
        n = len(chunk.first)
        start, end = chunk.runs(~is_space(chunk.points))
        owner = chunk.owner(start)
        words = chunk.span_hashes(chunk.prefix_hashes(), start, end)
        per = np.bincount(owner, minlength=n)
        grams = window_hashes(words, SHINGLE)
        whole = (
            owner[SHINGLE - 1 :] == owner[: len(grams)] if len(grams) else np.zeros(0, bool)
        )
        owners.append(owner[: len(grams)][whole] + base)
        hashes.append(grams[whole])
        first = np.cumsum(per) - per
        for i in np.flatnonzero((per > 0) & (per < SHINGLE)):
            owners.append(np.array([i + base]))
            hashes.append(window_hashes(words[first[i] : first[i] + per[i]], int(per[i])))
        base += n
    owner = np.concatenate(owners) if owners else np.zeros(0, np.int64)
    value = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
    order = np.lexsort((value, owner))
    owner, value = owner[order], value[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(new)
    return owner[at], value[at], np.diff(np.append(at, len(value)))


def _uniform(h: np.ndarray) -> np.ndarray:
    """In (0, 1)."""
    return ((h >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


def signatures(
    count: int, owner: np.ndarray, value: np.ndarray, weight: np.ndarray, size: int
) -> np.ndarray:
    """Signature of each of ``count`` weighted sets; zeros for an empty one.

    Weights are cut into regions [0, 1), [1, 2), [2, 4), ... In each, darts arrive
    along the rank axis as a Poisson process of the region's width as rate. All
    arrivals up to a rank of ``t / total weight`` are thrown, ``t`` darts on
    average, and more for a set that still lacks a coordinate.
    """
    best = np.full(count * size, np.inf)
    dart = np.zeros(count * size, np.uint64)
    total = np.bincount(owner, weights=weight, minlength=count)
    limit = size * (np.log(size) + 2) / np.maximum(total, 1)
    # a row for each region that a weight reaches
    levels = np.ceil(np.log2(np.maximum(weight, 1))).astype(np.int64) + 1
    row = np.repeat(np.arange(len(value)), levels)
    level = np.arange(len(row)) - np.repeat(np.cumsum(levels) - levels, levels)
    left = np.where(level == 0, 0.0, 2.0 ** (level - 1))
    width = np.where(level == 0, 1.0, left)
    seed = mixed(value[row] + level.astype(np.uint64) * _GOLD)
    own, reach = owner[row], weight[row].astype(np.float64)
    state = mixed(seed + _SILVER)
    rank = -np.log(_uniform(state)) / width
    # darts above this rank wait for a higher limit
    waiting = np.arange(len(row))
    missing = np.flatnonzero(total > 0)
    while len(missing):
        due = waiting[rank[waiting] < limit[own[waiting]]]
        while len(due):
            name = mixed(state[due] ^ _GOLD)
            inside = left[due] + _uniform(mixed(name ^ _SILVER)) * width[due] < reach[due]
            place = own[due] * size + (name % np.uint64(size)).astype(np.int64)
            place, ranks, name = place[inside], rank[due][inside], name[inside]
            np.minimum.at(best, place, ranks)
            first = best[place] == ranks
            dart[place[first]] = name[first]
            state[due] = mixed(state[due] + _SILVER)
            rank[due] -= np.log(_uniform(state[due])) / width[due]
            due = due[rank[due] < limit[own[due]]]
        empty = np.isinf(best.reshape(count, size)).any(axis=1)
        missing = missing[empty[missing]]
        limit[missing] *= 1.6
        waiting = np.flatnonzero(np.isin(own, missing)) if len(missing) else waiting
    return dart.reshape(count, size)


def band_keys(texts: list[str | None]) -> dict[str, pa.Array]:
    """One key per band of each text; none for a text without words."""
    parts, counts = [np.zeros((0, BANDS), np.uint64)], [np.zeros(0, np.int64)]
    # some texts at a time, to bound shingles and darts in memory
    for some, _ in chunked(texts):
        owner, value, weight = shingles(texts[some])
        n = some.stop - some.start
        for at in range(0, n, 256):
            low, high = np.searchsorted(owner, [at, min(n, at + 256)])
            made = signatures(
                min(n, at + 256) - at, owner[low:high] - at, value[low:high], weight[low:high],
                BANDS * ROWS,
            )
            keys = np.zeros((len(made), BANDS), np.uint64)
            for r in range(ROWS):
                keys = mixed(keys * _GOLD + made[:, r::ROWS])
            has = np.bincount(owner[low:high] - at, minlength=len(made)) > 0
            parts.append(mixed(keys + np.arange(BANDS, dtype=np.uint64) * _SILVER)[has])
            counts.append(np.where(has, BANDS, 0))
    keys = np.concatenate(parts)
    return {"keys": listed(keys.reshape(-1).view(np.int64), np.concatenate(counts))}


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard of two sets given as sorted hashes and counts."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    common = int(np.minimum(a[1][i], b[1][j]).sum())
    return common / max(1, int(a[1].sum()) + int(b[1].sum()) - common)


Profile = tuple[np.ndarray, np.ndarray]
# Members and characters of a block; larger buckets are compared block by block.
MEMBERS, CHARACTERS = 1024, 1 << 24


def _roots(n: int, pairs: np.ndarray) -> np.ndarray:
    """The smallest member of each member's component."""
    root = np.arange(n)
    while len(pairs):
        low = np.minimum(root[pairs[:, 0]], root[pairs[:, 1]])
        before = root.copy()
        np.minimum.at(root, root[pairs[:, 0]], low)
        np.minimum.at(root, root[pairs[:, 1]], low)
        while (deeper := root[root]).tolist() != root.tolist():
            root = deeper
        if (before == root).all():
            break
    return root


def linked(profiles: list[Profile], similar: float) -> np.ndarray:
    """Component root of each set under links of at least ``similar``, all pairs compared.

    A set counts as its (shingle, copy) elements, so overlaps are products of
    0/1 matrices over the elements that occur in several sets.
    """
    n = len(profiles)
    if n == 2:
        near = similarity(*profiles) >= similar
        return np.array([0, 0 if near else 1])
    sizes = np.array([int(c.sum()) for _, c in profiles], np.float64)
    member = np.repeat(np.arange(n), sizes.astype(np.int64))
    value = np.concatenate([np.repeat(v, c) for v, c in profiles])
    count = np.concatenate([c for _, c in profiles])
    copy = np.arange(len(value)) - np.repeat(np.cumsum(count) - count, count)
    element = mixed(value + copy.astype(np.uint64) * _GOLD)
    known, code, times = np.unique(element, return_inverse=True, return_counts=True)
    shared = np.cumsum(times > 1) - 1
    common = times[code] > 1
    member, code = member[common], shared[code[common]]
    overlap = np.zeros((n, n), np.float32)
    order = np.argsort(code, kind="stable")
    member, code = member[order], code[order]
    step = 4096
    for low in range(0, int((times > 1).sum()), step):
        a, b = np.searchsorted(code, [low, low + step])
        part = np.zeros((n, step), np.float32)
        part[member[a:b], code[a:b] - low] = 1
        overlap += part @ part.T
    union = sizes[:, None] + sizes[None, :] - overlap
    near = overlap / np.maximum(union, 1) >= similar
    return _roots(n, np.argwhere(np.triu(near, 1)))


def _links(batches, similar: float):
    """Links of the buckets in a stream of rows sorted by bucket: each member to the
    smallest of its component in the bucket, which keeps what is connected."""
    kept: list[pa.RecordBatch] = []

    def flush(table: pa.Table) -> pa.RecordBatch:
        table = table.combine_chunks()
        keys = table.column("bucket").to_pylist()
        owner, value, weight = shingles(table.column("text").to_pylist())
        cut = np.searchsorted(owner, np.arange(len(keys) + 1))
        left, right, at = [], [], 0
        while at < len(keys):
            end = at
            while end < len(keys) and keys[end] == keys[at]:
                end += 1
            profiles = [
                (value[cut[i] : cut[i + 1]], weight[cut[i] : cut[i + 1]]) for i in range(at, end)
            ]
            if len(profiles) > 1:
                roots = linked(profiles, similar)
                moved = np.flatnonzero(roots != np.arange(len(roots)))
                left.append(moved + at)
                right.append(roots[moved] + at)
            at = end
        nodes = table.column("node").combine_chunks()
        take = [pa.array(np.concatenate(x) if x else np.zeros(0, np.int64)) for x in (left, right)]
        return pa.RecordBatch.from_arrays([nodes.take(take[0]), nodes.take(take[1])], ["a", "b"])

    for batch in batches:
        if not batch.num_rows:
            continue
        # whole buckets alone are compared; the last of a batch may go on in the next
        keys = batch.column("bucket")
        last = keys[batch.num_rows - 1].as_py()
        end = batch.num_rows
        while end and keys[end - 1].as_py() == last:
            end -= 1
        if end:
            yield flush(pa.Table.from_batches([*kept, batch.slice(0, end)]))
            kept = [batch.slice(end)]
        elif kept and kept[-1].column("bucket")[0].as_py() != last:
            yield flush(pa.Table.from_batches(kept))
            kept = [batch]
        else:
            kept.append(batch)
    if kept:
        yield flush(pa.Table.from_batches(kept))


def similar_links(docs: DataFrame, similar: float = SIMILAR) -> tuple[DataFrame, DataFrame]:
    """Texts as nodes, and links between similar ones.

    A node is ``(no_id, id, digest)``: a distinct text, with its smallest document
    id first for order. Links connect all texts that proposed pairs of at least
    ``similar`` connect; not every such pair is listed.
    """
    given = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").withColumn(
        "digest", F.unhex(F.md5("text"))
    )
    texts = given.filter("text IS NOT NULL")
    ids = texts.groupBy("digest").agg(F.min("doc_id").alias("id"))
    node = F.struct(F.col("id").isNull().alias("no_id"), "id", "digest")
    nodes = checkpointed(ids.select("digest", node.alias("node")))

    # every text is signed where it is read; equal ones fall together before their bands part
    signed = texts.select("digest", F.octet_length("text").alias("size"), "text").mapInArrow(
        mapped(band_keys, ("digest", "size")), "digest binary, size int, keys array<bigint>"
    )
    once = signed.groupBy("digest").agg(F.first("size").alias("size"), F.first("keys").alias("keys"))
    slots = checkpointed(once.select("digest", "size", F.explode("keys").alias("key")))
    members = F.xxhash64("digest")
    buckets = slots.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("size").cast("bigint")).alias("characters"),
        F.bit_xor(members).alias("x"),
        F.bit_xor(F.xxhash64(members, F.lit(1))).alias("y"),
    )
    # bands that bring together the same texts need one comparison
    several = buckets.filter("n > 1").groupBy("n", "characters", "x", "y").agg(F.min("key").alias("key"))
    blocks = F.ceil(
        F.greatest(F.col("n") / MEMBERS, F.col("characters") / CHARACTERS)
    ).cast("int")
    chosen = several.select("key", blocks.alias("blocks"))
    own = F.pmod(F.xxhash64("digest", F.lit(2)), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    places = (
        slots.join(chosen, "key")
        .withColumn("own", own)
        .withColumn("other", other)
        .select(
            "digest",
            F.struct(
                "key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j")
            ).alias("bucket"),
        )
    )
    places = checkpointed(places)
    wanted = places.select("digest").distinct().join(nodes, "digest")
    # one row of each text that stands in a bucket
    same = (F.col("d.digest") == F.col("w.digest")) & F.col("d.doc_id").eqNullSafe(F.col("w.node.id"))
    found = texts.alias("d").join(wanted.alias("w").hint("shuffle_hash"), same)
    read = found.select("d.digest", "w.node", "d.text").dropDuplicates(["digest"])
    rows = places.join(read, "digest").select("bucket", "node", "text")
    sorted_rows = rows.repartition("bucket").sortWithinPartitions("bucket", "node")
    kind = nodes.schema["node"].dataType.simpleString()
    links = sorted_rows.mapInArrow(partial(_links, similar=similar), f"a {kind}, b {kind}")
    return nodes, links


def duplicate_classes(docs: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """``doc_id``, ``digest``, ``class_id`` (the smallest id of the class) and ``first`` of
    every row: whether it is its class's first, by id and then by digest, or a copy of that."""
    nodes, links = similar_links(docs, similar)
    labels = components(links)
    classes = nodes.join(labels, "node", "left").select(
        "digest", F.coalesce(F.col("label"), F.col("node")).alias("least")
    )
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.unhex(F.md5("text")).alias("digest"),
        F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False)).alias("worded"),
    )
    # texts without words stay alone
    classed = rows.join(classes, "digest", "left")
    alone = F.when(F.col("worded"), F.col("least.id")).otherwise(F.col("doc_id"))
    least = F.col("doc_id").eqNullSafe(F.col("least.id")) & (F.col("digest") == F.col("least.digest"))
    first = F.when(F.col("worded"), least).otherwise(F.lit(True))
    return classed.select("doc_id", "digest", "worded", alone.alias("class_id"), first.alias("first"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``class_id`` and ``kept`` of every row.

    Kept are the rows of the smallest id, of different texts under it those of one; rows
    of classes without any id are not.
    """
    own = F.coalesce(F.col("doc_id") == F.col("class_id"), F.lit(False))
    kept = (own & F.col("first")).alias("kept")
    return duplicate_classes(docs).select("doc_id", "class_id", kept)


def keep_one(docs: DataFrame) -> DataFrame:
    """One input row of each class, unchanged: one with the smallest id, of different texts
    under it the one of the smallest digest.

    Null texts and texts without words are a class for each row; of the latter equal rows
    of one id become one.
    """
    doc_id = F.col("doc_id").cast("bigint")
    text = ["no_id", "id", "digest"]
    # keys without nulls, so that rows without id are joined like others
    keys = {"no_id": doc_id.isNull(), "id": F.coalesce(doc_id, F.lit(0).cast("bigint"))}
    state = checkpointed(
        duplicate_classes(docs)
        .filter(F.col("digest").isNotNull() & (F.col("worded") | F.col("doc_id").isNotNull()))
        .withColumns(keys)
        # an exchange of its own lets Spark split the join above where many rows share a text
        .repartition(*text)
        .groupBy(*text)
        .agg((~F.bool_and("first")).alias("lost"), F.count(F.lit(1)).alias("n"))
        .filter("lost OR n > 1")
    )
    keyed = docs.select(
        F.struct("*").alias("row"),
        *[key.alias(name) for name, key in keys.items()],
        F.unhex(F.md5("text")).alias("digest"),
    )
    single = keyed.join(state.select(*text).hint("shuffle_hash"), text, "left_anti")
    repeated = state.filter("NOT lost")
    if repeated.isEmpty():
        return single.select("row.*")
    copies = keyed.join(repeated.select(*text), text, "left_semi").dropDuplicates(text)
    return single.unionByName(copies).select("row.*")


def classes_sql() -> str:
    """The classes in SQL, with all pairs that share a shingle compared."""
    return f"""
WITH RECURSIVE texts AS (
  SELECT text, min(doc_id) AS id,
         regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS words
  FROM documents GROUP BY text
), grams AS (
  SELECT id, unnest(CASE WHEN len(words) < {SHINGLE} THEN [array_to_string(words, ' ')]
    ELSE [array_to_string(words[i : i + {SHINGLE - 1}], ' ')
          FOR i IN range(1, len(words) - {SHINGLE - 2})] END) AS gram
  FROM texts WHERE len(words) > 0
), counted AS (
  SELECT id, gram, count(*) AS n FROM grams GROUP BY id, gram
), sizes AS (
  SELECT id, sum(n) AS size FROM counted GROUP BY id
), shared AS (
  SELECT a.id AS a, b.id AS b, sum(least(a.n, b.n)) AS common
  FROM counted a JOIN counted b ON a.gram = b.gram AND a.id < b.id GROUP BY a.id, b.id
), near AS (
  SELECT a, b FROM shared
  JOIN sizes s ON s.id = a JOIN sizes t ON t.id = b
  WHERE CAST(common AS DOUBLE) / (s.size + t.size - common) >= {SIMILAR}
), links AS (
  SELECT a, b FROM near UNION ALL SELECT b, a FROM near
), reach AS (
  SELECT id AS node, id AS other FROM sizes
  UNION
  SELECT r.node, l.b FROM reach r JOIN links l ON l.a = r.other
), classes AS (
  SELECT node AS id, min(other) AS class_id FROM reach GROUP BY node
)
SELECT doc_id, coalesce(c.class_id, doc_id) AS class_id, doc_id = coalesce(c.class_id, doc_id) AS kept
FROM documents d LEFT JOIN texts t ON d.text = t.text LEFT JOIN classes c ON t.id = c.id"""
