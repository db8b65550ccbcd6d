"""Bounded samples of labelled documents for training."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def remainder(divisor: int) -> Column:
    """crc32 of the document id as text, modulo ``divisor``; null for a null id."""
    return F.crc32(F.col("doc_id").cast("string")) % divisor


def labelled_sample(labels: DataFrame, label: str, allowed: Column, per_class: int) -> DataFrame:
    """At most ``per_class`` documents of each class: ``doc_id`` and ``label``.

    Documents come in the order of a hash of their id. Rows without id or label
    are no training data; a document labelled both ways counts as 1.
    """
    usable = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & allowed)
    one = usable.groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    classes = [one.filter(F.col("label") == v).orderBy(*order).limit(per_class) for v in (0, 1)]
    return classes[0].unionByName(classes[1])


def labelled_texts(
    docs: DataFrame, labels: DataFrame, label: str, allowed: Column, per_class: int
) -> DataFrame:
    """``doc_id``, ``label`` and ``text`` of the sample, one row for each document.

    Of different texts under one id the one of the smallest digest is taken. Rows are
    reduced where they lie, so a repeated id sends one row of each task on. Null reads
    as empty.
    """
    sample = labelled_sample(labels, label, allowed, per_class)
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", text.alias("text")).join(F.broadcast(sample), "doc_id")
    return rows.groupBy("doc_id", "label").agg(F.min_by("text", F.md5("text")).alias("text"))


def held_out(divisor: int, value: int) -> Column:
    return F.coalesce(remainder(divisor) == value, F.lit(False)).alias("held_out")
