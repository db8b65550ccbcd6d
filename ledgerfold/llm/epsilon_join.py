"""Embedding near-duplicates by epsilon grid order join.

Unit vectors are rotated to their principal dimensions; on the leading ones lies
a grid of cells as wide as the distance epsilon that a cosine allows. Vectors are
sorted by cell and cut into blocks. Two blocks meet only if their cells of the
first dimension touch and no leading dimension keeps them apart; then intervals of the two sequences are joined
recursively: a pair of intervals that are further apart than epsilon in some
leading dimension is skipped, a small one is compared vector by vector.

Null and zero vectors and those with null or non-finite components link with
nothing. Vectors of different lengths never link; each length is joined by itself,
with axes and blocks of its own. Equal vectors are one class from the
start and all link with each other; repeated rows too. An empty table gives no
rows; a null id takes part but is no component id unless it is alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerfold.llm.graph import components
from ledgerfold.session import checkpointed

COSINE = 0.9
LEADING, BLOCK, SMALL = 6, 4096, 128


def _matrix(column: pa.Array) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(column), -1)


def _units(vectors: np.ndarray) -> np.ndarray:
    """Unit vectors. The largest component is divided out first, for squares of very large
    or very small ones are no numbers."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def _moments(batches):
    """Sums of the unit vectors of a task and of their products, a row for each pair of
    dimensions; those of the vectors themselves have a second dimension of -1, the count -2."""
    n, total, products = 0, None, None
    for batch in batches:
        if batch.num_rows:
            u = _units(_matrix(batch.column("vector")))
            n += len(u)
            total = u.sum(axis=0) + (0 if total is None else total)
            products = u.T @ u + (0 if products is None else products)
    if n:
        i, j = np.triu_indices(len(total))
        lone = np.arange(len(total))
        columns = [
            np.concatenate([i, lone, [0]]).astype(np.int32),
            np.concatenate([j, lone * 0 - 1, [-2]]).astype(np.int32),
            np.concatenate([products[i, j], total, [float(n)]]),
        ]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["i", "j", "value"])


def principal(classes: DataFrame, leading: int) -> np.ndarray | None:
    """Leading principal directions as columns. Spark adds up the sums of all tasks; what
    comes to the driver is bounded by the square of the dimensions."""
    parts = classes.select("vector").mapInArrow(_moments, "i int, j int, value double")
    sums = parts.groupBy("i", "j").agg(F.sum("value").alias("value")).toPandas()
    if not len(sums):
        return None
    i, j, value = (sums[c].to_numpy() for c in ("i", "j", "value"))
    n, size = value[j == -2][0], int(i.max()) + 1
    mean, products = np.zeros(size), np.zeros((size, size))
    mean[i[j == -1]] = value[j == -1] / n
    both = j >= 0
    products[i[both], j[both]] = products[j[both], i[both]] = value[both] / n
    return np.linalg.eigh(products - np.outer(mean, mean))[1][:, ::-1][:, :leading].copy()


def _projected(batches, axes: np.ndarray, width: float):
    """Places (``shadow``) and cells of the vectors on the leading dimensions."""
    for batch in batches:
        if batch.num_rows:
            shadow = _units(_matrix(batch.column("vector"))) @ axes
            offsets = pa.array(np.arange(len(shadow) + 1, dtype=np.int32) * shadow.shape[1])
            cells = np.floor(shadow / width).astype(np.int32)
            made = [pa.ListArray.from_arrays(offsets, pa.array(x.reshape(-1))) for x in (shadow, cells)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *made], [*batch.schema.names, "shadow", "cells"]
            )


def _numbered(batches):
    """Cuts the sorted rows of a task into blocks."""
    at, task = 0, TaskContext.get().partitionId()
    for batch in batches:
        block = task * (1 << 32) + (at + np.arange(batch.num_rows)) // BLOCK
        at += batch.num_rows
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(block.astype(np.int64))], [*batch.schema.names, "block"]
        )


Sequence = tuple[np.ndarray, np.ndarray]


def near_tiles(a: Sequence, b: Sequence, cosine: float) -> Iterator[tuple[int, int, np.ndarray]]:
    """Where vectors of two sequences have at least this cosine, tile by tile: the first places
    of a tile in both, and a matrix of hits.

    A sequence is unit vectors and their projections, in grid order.
    """
    # a margin for rounding: projections of close vectors are not further apart
    far = np.sqrt(max(0.0, 2 - 2 * cosine)) + 1e-9

    def join(i: int, j: int, k: int, m: int) -> Iterator[tuple[int, int, np.ndarray]]:
        p, q = a[1][i:j], b[1][k:m]
        gap = np.maximum(p.min(axis=0) - q.max(axis=0), q.min(axis=0) - p.max(axis=0))
        if (gap > far).any():
            return
        if j - i <= SMALL and m - k <= SMALL:
            near = a[0][i:j] @ b[0][k:m].T >= cosine
            if near.any():
                yield i, k, near
        elif j - i >= m - k:
            cut = (i + j) // 2
            yield from join(i, cut, k, m)
            yield from join(cut, j, k, m)
        else:
            cut = (k + m) // 2
            yield from join(i, j, k, cut)
            yield from join(i, j, cut, m)

    if len(a[0]) and len(b[0]):
        yield from join(0, len(a[0]), 0, len(b[0]))


def sequence_join(a: Sequence, b: Sequence, cosine: float) -> np.ndarray:
    """Pairs of places, one in each sequence, with at least this cosine."""
    found = [np.argwhere(near) + (i, k) for i, k, near in near_tiles(a, b, cosine)]
    return np.concatenate(found) if found else np.zeros((0, 2), np.int64)


def _united(root: np.ndarray, one: np.ndarray, two: np.ndarray) -> None:
    """Join the components of pairs of places; a root is the smallest place of its component."""
    apart = root[one] != root[two]
    one, two = one[apart], two[apart]
    while len(one):
        low = np.minimum(root[one], root[two])
        np.minimum.at(root, root[one], low)
        np.minimum.at(root, root[two], low)
        while (root[root] != root).any():
            root[:] = root[root]
        apart = root[one] != root[two]
        one, two = one[apart], two[apart]


def _joined(key, table: pa.Table, axes: np.ndarray, cosine: float) -> pa.Table:
    """Links between two blocks (or within one): a row per vector with partners there, with
    their number and the smallest node it is connected to there."""
    names = ["node", "near", "links"]
    table = table.combine_chunks()
    left, right = key[0].as_py(), key[1].as_py()
    block = table.column("block").to_numpy()
    weight = table.column("copies").to_numpy()
    vectors = _units(_matrix(table.column("vector").combine_chunks()))
    shadow = vectors @ axes
    node = table.column("node").combine_chunks()
    order = np.lexsort((*np.floor(shadow.T[::-1] / 0.1), block))

    def side(which: int) -> tuple[np.ndarray, tuple[np.ndarray, np.ndarray]]:
        own = order[block[order] == which]
        return own, (vectors[own], shadow[own])

    at, one = side(left)
    to, two = side(right)
    # places by node, so that the smallest root is the smallest node
    n = len(vectors)
    keys = node.field("id").to_numpy(zero_copy_only=False)
    missing = node.field("no_id").to_numpy(zero_copy_only=False)
    digest = np.array(node.field("digest").to_pylist(), object)
    by_node = sorted(range(n), key=lambda i: (missing[i], keys[i] if not missing[i] else 0, digest[i]))
    place = np.empty(n, np.int64)
    place[by_node] = np.arange(n)
    root, links = np.arange(n), np.zeros(n)
    # a tile at a time: links are counted and components joined, no pair is kept
    for i, k, near in near_tiles(one, two, cosine):
        rows, columns = at[i : i + near.shape[0]], to[k : k + near.shape[1]]
        if left == right:
            near = near & (rows[:, None] < columns[None, :])
        links[rows] += near @ weight[columns].astype(float)
        links[columns] += weight[rows].astype(float) @ near
        x, y = np.nonzero(near)
        _united(root, place[rows[x]], place[columns[y]])
    some = np.flatnonzero(links > 0)
    near = np.array(by_node, np.int64)[root[place[some]]]
    return pa.table(
        [node.take(pa.array(some)), node.take(pa.array(near)), pa.array(links[some].astype(np.int64))],
        names,
    )


def _usable(vectors: DataFrame) -> DataFrame:
    """Ids with the vector as doubles, null where it links with nothing."""
    doubles = F.col("embedding").cast("array<double>")
    sound = F.forall(doubles, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    nonzero = F.exists(doubles, lambda x: x != 0)
    fits = F.coalesce(sound & nonzero, F.lit(False))
    return vectors.select(
        F.col("vec_id").cast("bigint").alias("vec_id"),
        F.when(fits, doubles).alias("vector"),
    ).withColumn("digest", F.unhex(F.md5(F.to_json(F.struct("vector")))))


def _compared(classes: DataFrame, count: int, cosine: float) -> DataFrame:
    """Links between ``count`` distinct vectors of one length, as ``_joined`` has them."""
    axes = principal(classes, LEADING)
    width = float(np.sqrt(max(2 - 2 * cosine, 1e-12)))
    kind = classes.schema["node"].dataType.simpleString()
    placed = classes.mapInArrow(
        partial(_projected, axes=axes, width=width),
        f"node {kind}, copies bigint, vector array<double>, shadow array<double>, cells array<int>",
    )
    # grid order: sorted by cell (equal cells by digest), cut into blocks
    parts = max(1, -(-count // BLOCK))
    ordered = placed.repartitionByRange(parts, "cells", "node.digest").sortWithinPartitions(
        "cells", "node.digest"
    )
    own = checkpointed(
        ordered.mapInArrow(
            _numbered,
            f"node {kind}, copies bigint, vector array<double>, shadow array<double>, "
            "cells array<int>, block bigint",
        )
    )
    lead = range(axes.shape[1])
    boxes = checkpointed(
        own.groupBy("block").agg(
            F.min(F.col("cells")[0]).alias("from"),
            F.max(F.col("cells")[0]).alias("to"),
            F.array(*[F.min(F.col("shadow")[d]) for d in lead]).alias("low"),
            F.array(*[F.max(F.col("shadow")[d]) for d in lead]).alias("high"),
        )
    )
    # blocks whose first cells touch, unless some leading dimension keeps them apart
    a = boxes.select(
        F.col("block").alias("left"), F.col("low").alias("low_a"), F.col("high").alias("high_a"),
        F.explode(F.sequence(F.col("from") - 1, F.col("to") + 1)).alias("cell"),
    )
    b = boxes.select(
        F.col("block").alias("right"), F.col("low").alias("low_b"), F.col("high").alias("high_b"),
        F.explode(F.sequence("from", "to")).alias("cell"),
    )
    near = F.lit(True)
    for d in lead:
        gap = F.greatest(F.col("low_a")[d] - F.col("high_b")[d], F.col("low_b")[d] - F.col("high_a")[d])
        near = near & (gap <= width + 1e-9)
    meet = a.join(b, "cell").filter((F.col("left") <= F.col("right")) & near)
    meet = meet.select("left", "right").distinct()
    each = meet.select("left", "right", F.explode(F.array_distinct(F.array("left", "right"))).alias("block"))

    def join(key, table):
        return _joined(key, table, axes, cosine)

    compared = (
        each.join(own.select("block", "node", "copies", "vector"), "block")
        .groupBy("left", "right")
        .applyInArrow(join, f"node {kind}, near {kind}, links bigint")
    )
    return checkpointed(compared)


def linked_vectors(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every vector."""
    rows = _usable(vectors)
    fits = F.col("vector").isNotNull()
    classes = checkpointed(
        rows.filter(fits)
        .groupBy("digest")
        .agg(
            F.min("vec_id").alias("id"),
            F.count(F.lit(1)).alias("copies"),
            F.first("vector").alias("vector"),
        )
        .select(
            F.struct(F.col("id").isNull().alias("no_id"), "id", "digest").alias("node"),
            "copies",
            "vector",
        )
    )
    length = F.size("vector").alias("length")
    lengths = classes.groupBy(length).count().orderBy("length").collect()
    if not lengths:
        alone = F.col("vec_id")
        return rows.select(
            "vec_id", F.lit(0).cast("bigint").alias("n_links"), alone.alias("component_id"),
            F.lit(True).alias("kept"),
        )
    # a vector that is alone with its length has copies at the most
    several = [r for r in lengths if r["count"] > 1] or lengths[:1]
    each_length = [
        _compared(classes.filter(F.size("vector") == r.length), r["count"], cosine) for r in several
    ]
    compared = reduce(DataFrame.unionByName, each_length)
    links = compared.groupBy("node").agg(F.sum("links").alias("links"))
    labels = components(compared.select(F.col("node").alias("a"), F.col("near").alias("b")))
    known = (
        classes.select("node", "copies")
        .join(links, "node", "left")
        .join(labels, "node", "left")
        .select(
            F.col("node.digest").alias("digest"),
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).cast("bigint").alias("n_links"),
            F.coalesce("label.id", "node.id").alias("component_id"),
        )
    )
    alone = F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    with_key = rows.select("vec_id", F.when(fits, F.col("digest")).alias("digest"))
    return with_key.join(known, "digest", "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0).cast("bigint")).alias("n_links"),
        alone.alias("component_id"),
        alone.eqNullSafe(F.col("vec_id")).alias("kept"),
    )


def links_sql() -> str:
    """The same in SQL: every vector against every other."""
    return f"""
WITH RECURSIVE vectors AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
), units AS (
  SELECT vec_id, v, sqrt(list_inner_product(v, v)) AS length FROM (
    SELECT vec_id, list_transform(v, lambda x: x / list_max(list_transform(v, lambda y: abs(y)))) AS v
    FROM vectors
    WHERE v IS NOT NULL AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(v, lambda x: x <> 0)) > 0)
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM units a JOIN units b ON a.vec_id <> b.vec_id
  WHERE list_inner_product(a.v, b.v) / (a.length * b.length) >= {COSINE}
), reach AS (
  SELECT vec_id AS node, vec_id AS other FROM embeddings
  UNION
  SELECT r.node, l.b FROM reach r JOIN links l ON l.a = r.other
), parts AS (
  SELECT node, min(other) AS component_id FROM reach GROUP BY node
), counts AS (
  SELECT a, count(*) AS n FROM links GROUP BY a
)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id,
  vec_id = component_id AS kept
FROM embeddings JOIN parts ON vec_id = node LEFT JOIN counts ON vec_id = a"""
