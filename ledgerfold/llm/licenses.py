"""Licence scan by diagonal voting.

Hashes of all rolling word pairs of all texts are joined to the positions of the
same pairs in licence templates. Each match votes for a diagonal (word position
in the text minus position in the template); votes are gathered by diagonal,
neighbouring diagonals are merged, which bridges inserted and missing words, and
the span of a merged diagonal is verified by the template words it covers and by
its length. Base phrases count where their words stand consecutively: where one
diagonal holds every pair of the phrase.

Null and empty texts have no words, no labels and score 0. Rows are told apart
by id and text, so repeated rows get equal results; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerfold.llm.text import Chunk, chunked, listed, mapped, per_text, window_hashes

GRAM = 2
# Diagonals this close together are one place.
NEIGHBOUR = 2
# A merged diagonal is a licence when it covers so much of the template, in a
# span at most so many times as long.
COVERED, STRETCH = 0.8, 1.5


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    base: bool = False
    # words that tell it from similar notices; the place has to cover them
    key: str = ""


# The base phrases, and notices of well-known licences.
TEMPLATES = (
    Template("mit", "mit license", base=True),
    Template("apache", "apache license", base=True),
    Template("gpl", "general public license", base=True),
    Template("mit", "released under the mit license", key="mit"),
    Template(
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this "
        "software and associated documentation files the software to deal in the software "
        "without restriction",
    ),
    Template("apache", "licensed under the apache license version 2 0", key="apache"),
    Template(
        "gpl", "this work is licensed under the gnu general public license version 3", key="gnu"
    ),
    Template("lgpl", "licensed under the gnu lesser general public license", key="lesser"),
    Template("agpl", "licensed under the gnu affero general public license", key="affero"),
    Template("cc-by-nc", "licensed under cc by nc 4 0", key="by nc"),
    Template("cc-by-sa", "licensed under cc by sa 4 0", key="by sa"),
    Template("cc-by", "licensed under a creative commons attribution license", key="creative"),
    Template("mpl", "subject to the terms of the mozilla public license", key="mozilla"),
    Template(
        "bsd",
        "redistribution and use in source and binary forms with or without modification are "
        "permitted provided that the following conditions are met",
    ),
    Template("reserved", "all rights reserved"),
)


def words_of(chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and owners of the words, A-Z in lower case."""
    c = chunk.points
    lower = np.where((c >= 0x41) & (c <= 0x5A), c + 0x20, c)
    inside = ((lower >= 0x30) & (lower <= 0x39)) | ((lower >= 0x61) & (lower <= 0x7A))
    start, end = chunk.runs(inside | (lower >= 0x80))
    sums = chunk.prefix_hashes(lower)
    return chunk.span_hashes(sums, start, end), chunk.owner(start)


def count_words(texts: list[str | None]) -> dict[str, np.ndarray]:
    counts = [per_text(len(c.first), words_of(c)[1]) for _, c in chunked(texts)]
    return {"n_words": np.concatenate(counts) if counts else np.zeros(0, np.int64)}


def rolling(texts: list[str | None]) -> dict[str, pa.Array]:
    """Hashes of all stretches of ``GRAM`` words of each text, in order."""
    values, counts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for _, chunk in chunked(texts):
        words, owner = words_of(chunk)
        grams = window_hashes(words, GRAM)
        whole = owner[GRAM - 1 :] == owner[: len(grams)] if len(grams) else np.zeros(0, bool)
        values.append(grams[whole].view(np.int64))
        counts.append(per_text(len(chunk.first), owner[: len(grams)][whole]))
    return {"grams": listed(np.concatenate(values), np.concatenate(counts))}


def template_rows(templates: tuple[Template, ...]) -> list[tuple[int, int, int]]:
    """``(template, position, gram)`` of every pair of every template."""
    grams = rolling([t.text for t in templates])["grams"].to_pylist()
    return [(i, at, g) for i, found in enumerate(grams) for at, g in enumerate(found)]


def votes(docs: DataFrame, templates: tuple[Template, ...]) -> DataFrame:
    """``doc_id, digest, template, diagonal`` with the template positions that match on it."""
    spark = docs.sparkSession
    keyed = docs.select("doc_id", F.md5("text").alias("digest"), "text")
    coded = keyed.mapInArrow(
        mapped(rolling, ("doc_id", "digest")), "doc_id bigint, digest string, grams array<bigint>"
    )
    pairs = coded.select("doc_id", "digest", F.posexplode("grams").alias("at", "gram"))
    known = spark.createDataFrame(template_rows(templates), "template int, place int, gram bigint")
    # a few hundred template positions, a fixed number
    matched = pairs.join(F.broadcast(known), "gram")
    diagonal = (F.col("at") - F.col("place")).alias("diagonal")
    return matched.groupBy("doc_id", "digest", "template", diagonal).agg(
        F.collect_set("place").alias("places")
    )


def scan(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """Verified places: ``doc_id, digest, label, base, first_word, last_word, score``.

    A base place starts at its diagonal and covers all of its phrase.
    """
    spark = docs.sparkSession
    rows = [
        (i, t.label, t.base, len(t.text.split()), list(map(t.text.split().index, t.key.split())))
        for i, t in enumerate(templates)
    ]
    names = spark.createDataFrame(
        rows, "template int, label string, base boolean, size int, keys array<int>"
    )
    found = votes(docs, templates).join(F.broadcast(names), "template")
    exact = found.filter(
        F.col("base") & (F.size("places") == F.col("size") - (GRAM - 1)) & (F.col("diagonal") >= 0)
    ).select(
        "doc_id", "digest", "label", "base",
        F.col("diagonal").cast("bigint").alias("first_word"),
        (F.col("diagonal") + F.col("size") - 1).cast("bigint").alias("last_word"),
        F.lit(1.0).alias("score"),
    )

    place = Window.partitionBy("doc_id", "digest", "template").orderBy("diagonal")
    gap = F.col("diagonal") - F.lag("diagonal").over(place) > NEIGHBOUR
    loose = found.filter(~F.col("base"))
    merged = loose.withColumn("new", F.coalesce(gap, F.lit(True)).cast("int")).withColumn(
        "place", F.sum("new").over(place)
    )
    start = F.col("diagonal") + F.array_min("places")
    end = F.col("diagonal") + F.array_max("places") + (GRAM - 1)
    spans = merged.groupBy("doc_id", "digest", "template", "place", "label", "size", "keys").agg(
        F.min(start).cast("bigint").alias("first_word"),
        F.max(end).cast("bigint").alias("last_word"),
        F.array_distinct(F.flatten(F.collect_list("places"))).alias("places"),
    )
    # each place covers GRAM template words
    covered = F.array_distinct(
        F.flatten(F.transform("places", lambda p: F.sequence(p, p + (GRAM - 1))))
    )
    length = F.col("last_word") - F.col("first_word") + 1
    keyed = spans.withColumn("covers", covered).filter(
        F.size(F.array_except("keys", "covers")) == 0
    )
    verified = keyed.withColumn("covered", F.size("covers") / F.col("size")).withColumn(
        "score", F.col("covered") * F.least(F.lit(1.0), F.col("size") / length)
    )
    near = verified.filter(
        (F.col("covered") >= COVERED) & (length <= STRETCH * F.col("size"))
    ).select(
        "doc_id", "digest", "label", F.lit(False).alias("base"), "first_word", "last_word", "score"
    )
    return exact.unionByName(near)


def license_labels(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """Per document its words, base places, and the labels of all verified places."""
    base = F.col("base")

    def joined(condition: Column | None = None) -> Column:
        label = F.col("label") if condition is None else F.when(condition, F.col("label"))
        return F.array_join(F.sort_array(F.collect_set(label)), ",")

    by_doc = scan(docs, templates).groupBy(
        F.col("doc_id").alias("__id"), F.col("digest").alias("__digest")
    ).agg(
        F.count_if(base).alias("n_base"),
        F.min(F.when(base, F.col("first_word"))).alias("first_word"),
        F.max(F.when(base, F.col("first_word"))).alias("last_word"),
        joined(base).alias("base_labels"),
        joined().alias("labels"),
        F.max("score").alias("score"),
    )
    keyed = docs.select("doc_id", F.md5("text").alias("digest"), "text")
    counted = keyed.mapInArrow(
        mapped(count_words, ("doc_id", "digest")), "doc_id bigint, digest string, n_words bigint"
    )
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("digest") == F.col("__digest"))
    return counted.join(by_doc, same, "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_base", F.lit(0).cast("bigint")).alias("n_base"),
        "first_word",
        "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
