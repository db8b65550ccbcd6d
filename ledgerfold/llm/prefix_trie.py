"""Trie of conversations by their first turns, with totals over subtrees.

A node is a distinct sequence of first turns. Its key is the exclusive or of hashes of
(place, role, text) over those turns, 128 bits in two numbers, so keys are running
aggregates and a parent's key is one step away.

Totals travel from the leaves to the root by time-forward processing: the nodes of a shard
are sorted by level, deepest first (Spark's external sort), every node sends its totals
to its parent through a priority queue ordered like the nodes, and finds what its children
sent at the head of the queue. The queue spills sorted runs, so a shard of any size takes
bounded memory. A shard is made of whole subtrees: a subtree with more than 1 / ``SHARES`` of
all nodes is cut at the next level, down to ``CUTS`` levels. The nodes above the cuts, at
most ``SHARES * (CUTS - 1)`` and the root, are swept last, fed with the sums of the shard roots.

* Turns are ordered by number (null first), then by a digest of role and text.
* A null role or text is empty. Rows without ``conv_id`` belong to no conversation and are
  left out. Repeated rows are turns like any other.
* An empty table has no conversation, so not even a root.
* Texts are hashed where they are read, and never shuffled; a turn takes some 50 bytes.
* Numbers and keys along a conversation are made in blocks of ordered rows, so one that
  holds a third of all turns is spread; its nodes may be one shard, swept in one pass.
"""

from __future__ import annotations

import hashlib
import heapq
import pickle
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerfold.session import checkpointed

CUTS, SHARES = 8, 256
# Messages that a queue holds in memory, and rows handed over at once.
_IN_MEMORY, _ROWS = 200_000, 4096
_NODE = ["depth", "x1", "x2"]


class SpillingQueue:
    """A priority queue that keeps ``most`` items in memory, the others as sorted runs on disk.

    The files are private to the task, as Spark's own spill files are, and vanish with it.
    """

    def __init__(self, most: int = _IN_MEMORY) -> None:
        self._most, self._heap, self._heads, self._runs = most, [], [], []

    def push(self, item: tuple) -> None:
        heapq.heappush(self._heap, item)
        if len(self._heap) > self._most:
            run = tempfile.TemporaryFile()
            for one in sorted(self._heap):
                pickle.dump(one, run)
            run.seek(0)
            self._heap = []
            self._runs.append(run)
            self._next(len(self._runs) - 1)

    def _next(self, number: int) -> None:
        try:
            heapq.heappush(self._heads, (pickle.load(self._runs[number]), number))
        except EOFError:
            self._runs[number].close()

    def head(self) -> tuple | None:
        tops = ([self._heap[0]] if self._heap else []) + ([self._heads[0][0]] if self._heads else [])
        return min(tops, default=None)

    def pop(self) -> tuple:
        if self._heads and (not self._heap or self._heads[0][0] < self._heap[0]):
            item, number = heapq.heappop(self._heads)
            self._next(number)
            return item
        return heapq.heappop(self._heap)


def _along(rows: DataFrame, order: list[Column], values: dict[str, Column], xor: bool) -> DataFrame:
    """Running sums (or exclusive ors) of ``values`` along each conversation, in blocks.

    The rows are cut into ordered blocks by range; what a conversation has in earlier
    blocks is added to the running value within the block.
    """
    gathered = F.bit_xor if xor else F.sum
    blocks = checkpointed(
        rows.withColumns(values | {"tie": F.monotonically_increasing_id()})
        .repartitionByRange(F.col("conv"), *order, F.col("tie"))
        .withColumn("block", F.spark_partition_id())
    )
    parts = blocks.groupBy("conv", "block").agg(*[gathered(n).alias(n) for n in values])
    earlier = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = parts.select(
        F.col("conv").alias("c"),
        F.col("block").alias("b"),
        *[gathered(n).over(earlier).alias(f"{n}_before") for n in values],
    ).dropna()
    here = Window.partitionBy("conv", "block").orderBy(*order, F.col("tie"))
    here = here.rowsBetween(Window.unboundedPreceding, 0)
    inside = blocks.withColumns({n: gathered(n).over(here) for n in values})
    joined = inside.join(before, (F.col("conv") == F.col("c")) & (F.col("block") == F.col("b")), "left")
    whole = {}
    for n in values:
        first = F.coalesce(f"{n}_before", F.lit(0))
        whole[n] = F.col(n).bitwiseXOR(first) if xor else F.col(n) + first
    return joined.withColumns(whole).select(*rows.columns, *values)


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """``conv``, ``at`` (from 0), two hashes ``k1`` and ``k2`` of role and text, ``n_bytes``."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    rows = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").alias("conv"),
        F.col("turn").alias("no"),
        digest.alias("digest"),
        F.octet_length(text).cast("bigint").alias("n_bytes"),
    )
    halves = [
        F.conv(F.substring("digest", 1 + 15 * k, 15), 16, 10).cast("bigint").alias(f"k{k + 1}")
        for k in range(2)
    ]
    narrow = rows.select("conv", "no", *halves, "n_bytes")
    order = [F.col("no").asc_nulls_first(), F.col("k1"), F.col("k2")]
    made = _along(narrow, order, {"n": F.lit(1).cast("bigint")}, xor=False)
    return made.select("conv", (F.col("n") - 1).alias("at"), "k1", "k2", "n_bytes")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns of conversations that begin like their group's first one, and all conversations.

    The first ``h`` turns of conversation ``c - c % 5`` stand in for those of ``c``, with
    ``h`` the checksum of ``c`` modulo 9.
    """
    own = turns.withColumns({"h": _taken("conv"), "base": F.col("conv") - F.col("conv") % 5})
    all_convs = turns.select("conv").distinct()
    # eight rows of a base at most, for five conversations at most
    heads = turns.filter("conv % 5 = 0 AND at < 8")
    groups = all_convs.withColumns({"h": _taken("conv"), "base": F.col("conv") - F.col("conv") % 5})
    lent = groups.join(heads.withColumnRenamed("conv", "base"), "base").filter("at < h")
    sizes = heads.groupBy(F.col("conv").alias("base")).agg(F.count(F.lit(1)).alias("has"))
    rest = own.filter("at >= h").join(sizes, "base", "left")
    shift = F.least(F.col("h"), F.coalesce("has", F.lit(0))) - F.col("h")
    columns = ["conv", "at", "k1", "k2", "n_bytes"]
    made = lent.select(*columns).unionByName(rest.withColumn("at", F.col("at") + shift).select(*columns))
    return made, all_convs


def _taken(conv: str) -> Column:
    return F.crc32(F.col(conv).cast("string")) % 9


def _memberships(turns: DataFrame) -> DataFrame:
    """A row per conversation and node below the root that it starts with.

    ``path`` has the first keys on the way, ``p1`` and ``p2`` are the parent's key.
    """
    step = turns.withColumns(
        {"e1": F.xxhash64("at", "k1", "k2"), "e2": F.xxhash64("k2", "at", F.lit("second"), "k1")}
    )
    keys = {"x1": F.col("e1"), "x2": F.col("e2")}
    keyed = _along(step, [F.col("at")], keys, xor=True).select(
        "conv",
        (F.col("at") + 1).alias("depth"),
        "x1",
        "x2",
        F.col("x1").bitwiseXOR(F.col("e1")).alias("p1"),
        F.col("x2").bitwiseXOR(F.col("e2")).alias("p2"),
        "n_bytes",
    )
    return checkpointed(keyed)


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest of ids for every stretch of equal nodes; the ids are hashed as they pass."""
    node, digest, done = None, None, []

    def handed() -> pa.RecordBatch:
        names = [*_NODE, "ends_sha256"]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done, strict=True)], names)

    for batch in batches:
        for *key, conv in zip(*[batch.column(c).to_pylist() for c in [*_NODE, "conv"]], strict=True):
            if key != node:
                if node is not None:
                    done.append((*node, digest.hexdigest()))
                node, digest = key, hashlib.sha256(str(conv).encode())
            else:
                digest.update(f",{conv}".encode())
        if len(done) >= _ROWS:
            yield handed()
            done = []
    if node is not None:
        done.append((*node, digest.hexdigest()))
        yield handed()


_SWEPT = (
    "depth bigint, x1 bigint, x2 bigint, p1 bigint, p2 bigint, conv_id bigint, n_convs bigint, "
    "top boolean, n_children bigint, n_leaves bigint, saved_tokens bigint"
)
_PASSED = ["depth", "x1", "x2", "p1", "p2", "conv_id", "n_convs", "top"]


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Time-forward processing over nodes sorted by level (deepest first) and key."""
    queue = SpillingQueue()
    for batch in batches:
        given = {c: batch.column(c).to_pylist() for c in batch.schema.names}
        totals = []
        for i in range(batch.num_rows):
            key = (-given["depth"][i], given["x1"][i], given["x2"][i])
            children, leaves, saved = (given[c][i] for c in ("sent_children", "sent_leaves", "sent_saved"))
            while (head := queue.head()) is not None and head[0] == key:
                _, n, tokens = queue.pop()
                children, leaves, saved = children + 1, leaves + n, saved + tokens
            leaves = leaves if children else 1
            saved += (given["n_convs"][i] - 1) * given["n_bytes"][i]
            totals.append((children, leaves, saved))
            if not given["top"][i]:
                parent = (1 - given["depth"][i], given["p1"][i], given["p2"][i])
                queue.push((parent, leaves, saved))
        if totals:
            columns = [batch.column(c) for c in _PASSED]
            made = [pa.array(c, pa.int64()) for c in zip(*totals, strict=True)]
            yield pa.RecordBatch.from_arrays(
                columns + made, [*_PASSED, "n_children", "n_leaves", "saved_tokens"]
            )


def _swept(nodes: DataFrame) -> DataFrame:
    order = [F.col("depth").desc(), F.col("x1"), F.col("x2")]
    return nodes.sortWithinPartitions(*order).mapInArrow(_sweep, _SWEPT)


def prefix_trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """Nodes of the trie over numbered turns (``conv``, ``at``, ``k1``, ``k2``, ``n_bytes``).

    ``convs`` lists all conversations, those without turns too. Per node: ``conv_id`` (smallest
    member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``,
    ``saved_tokens`` and ``ends_sha256`` (ids of the members that end here).
    """
    rows = _memberships(turns)
    heads = (
        rows.filter(F.col("depth") <= CUTS)
        .groupBy("conv")
        .agg(F.sort_array(F.collect_list(F.struct("depth", "x1"))).alias("path"))
        .select("conv", F.col("path.x1").alias("path"))
    )
    root = convs.select(
        "conv", *[F.lit(0).cast("bigint").alias(c) for c in (*_NODE, "p1", "p2", "n_bytes")],
        F.array().cast("array<bigint>").alias("path"),
    )
    members = rows.join(heads, "conv").unionByName(root)
    nodes = checkpointed(
        members.groupBy(*_NODE).agg(
            F.min("conv").alias("conv_id"),
            F.count(F.lit(1)).alias("n_convs"),
            *[F.min(c).alias(c) for c in ("p1", "p2", "n_bytes", "path")],
        )
    ).withColumn("path", F.slice("path", 1, F.least("depth", F.lit(CUTS)).cast("int")))
    swept = _totals(nodes)
    last = rows.groupBy("conv").agg(F.max("depth").alias("depth"))
    ending = convs.join(last, "conv", "left").select(
        "conv", F.coalesce("depth", F.lit(0)).cast("bigint").alias("depth")
    )
    at_end = rows.select("conv", *_NODE).unionByName(root.select("conv", *_NODE))
    ends = (
        at_end.join(ending, ["conv", "depth"], "left_semi")
        .repartition(*_NODE)
        .sortWithinPartitions(*_NODE, "conv")
        .select(*_NODE, F.col("conv"))
        .mapInArrow(_ends, "depth bigint, x1 bigint, x2 bigint, ends_sha256 string")
    )
    parents = nodes.select(
        (F.col("depth") + 1).alias("depth"),
        F.col("x1").alias("p1"),
        F.col("x2").alias("p2"),
        F.col("conv_id").alias("parent_conv_id"),
    )
    none = hashlib.sha256(b"").hexdigest()
    return (
        swept.join(parents, ["depth", "p1", "p2"], "left")
        .join(ends, _NODE, "left")
        .select(
            "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
            "saved_tokens", F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"),
        )
    )


def _totals(nodes: DataFrame) -> DataFrame:
    """Nodes with their totals: all shards side by side, then what lies above them."""
    total = nodes.count()
    # at most SHARES * (CUTS - 1) keys, whatever the input
    above = (
        nodes.select(F.posexplode("path").alias("level", "key"))
        .filter(F.col("level") < CUTS - 1)
        .groupBy("level", "key")
        .count()
        .filter(F.col("count") * SHARES > total)
    )
    hot = F.broadcast(above.agg(F.collect_set(F.struct("level", "key")).alias("hot")))
    level = F.filter(
        F.sequence(F.lit(0), F.size("path") - 1),
        lambda i: ~F.array_contains("hot", F.struct(i.alias("level"), F.get("path", i).alias("key"))),
    )
    level = F.when(F.size("path") > 0, F.get(level, 0))
    none = F.lit(0).cast("bigint")
    placed = (
        nodes.crossJoin(hot)  # one row
        .withColumn("level", level)
        .withColumn("shard", F.get("path", F.col("level")))
        .withColumns({"sent_children": none, "sent_leaves": none, "sent_saved": none})
        .withColumn("top", F.coalesce(F.col("depth") == F.col("level") + 1, F.lit(True)))
        .drop("hot", "path", "level")
    )
    below = checkpointed(_swept(placed.filter("shard IS NOT NULL").repartition("shard")))
    sent = (
        below.filter("top")
        .groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("x1"), F.col("p2").alias("x2"))
        .agg(
            F.count(F.lit(1)).alias("sent_children"),
            F.sum("n_leaves").alias("sent_leaves"),
            F.sum("saved_tokens").alias("sent_saved"),
        )
    )
    upper = placed.filter("shard IS NULL").drop("sent_children", "sent_leaves", "sent_saved")
    upper = upper.withColumn("top", F.col("depth") == 0).join(sent, _NODE, "left").fillna(
        0, ["sent_children", "sent_leaves", "sent_saved"]
    )
    return below.unionByName(_swept(upper.coalesce(1)))


def trie_report(conversations: DataFrame) -> DataFrame:
    """The trie of the rebuilt conversations."""
    return prefix_trie(*rebuilt(numbered_turns(conversations)))


def _crc32_sql(number: str) -> str:
    """Checksum of the decimal digits of a number."""
    bit = "lambda x, i: xor(x >> 1, 3988292384 * (x & 1))"
    byte = f"list_reduce(list_prepend(xor(c, b), range(8)), {bit})"
    digits = f"list_transform(string_split(CAST({number} AS VARCHAR), ''), lambda d: ord(d)::BIGINT)"
    read = f"list_reduce(list_prepend(4294967295::BIGINT, {digits}), lambda c, b: {byte})"
    return f"xor(4294967295, {read})"


def trie_sql() -> str:
    return f"""
WITH own AS (
  SELECT conv_id, list(t ORDER BY turn NULLS FIRST, sha256(strlen(t.role) || ':' || t.role || t.text)) AS turns
  FROM (SELECT conv_id, turn, {{'role': coalesce(role, ''), 'text': coalesce(text, '')}} AS t
        FROM conversations WHERE conv_id IS NOT NULL)
  GROUP BY conv_id
), taken AS (
  SELECT *, conv_id - conv_id % 5 AS base, {_crc32_sql("conv_id")} % 9 AS h FROM own
), rebuilt AS (
  SELECT c.conv_id, list_concat(coalesce(list_slice(b.turns, 1, c.h), []),
    list_slice(c.turns, c.h + 1, len(c.turns))) AS turns
  FROM taken c LEFT JOIN own b ON b.conv_id = c.base
), members AS (
  SELECT conv_id, turns[1:d] AS seq, d AS depth, len(turns) = d AS ends
  FROM (SELECT conv_id, turns, unnest(range(0, len(turns) + 1)) AS d FROM rebuilt)
), nodes AS (
  SELECT seq, any_value(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)
      FILTER (WHERE ends), '')) AS ends_sha256
  FROM members GROUP BY seq
), children AS (
  SELECT seq[1:depth - 1] AS up, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1
), counted AS (
  SELECT n.*, coalesce(c.n_children, 0) AS n_children,
    CASE WHEN depth = 0 THEN 0 ELSE (n_convs - 1) * strlen(seq[depth].text) END AS saved
  FROM nodes n LEFT JOIN children c ON c.up = n.seq
), totals AS (
  SELECT seq[1:k] AS up, sum(saved) AS saved_tokens, count(*) FILTER (WHERE n_children = 0) AS n_leaves
  FROM (SELECT *, unnest(range(0, depth + 1)) AS k FROM counted) GROUP BY 1
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children,
  CAST(t.n_leaves AS BIGINT) AS n_leaves, CAST(t.saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM counted n JOIN totals t ON t.up = n.seq
LEFT JOIN nodes p ON n.depth > 0 AND p.seq = n.seq[1:n.depth - 1]"""
