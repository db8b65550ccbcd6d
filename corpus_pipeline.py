"""From raw documents to encoded training data: five corpus operators in a row.

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows it is given. All
but the last return the columns of ``documents``. ``run`` writes each stage to
the shared folder and reads it again for the next.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ledgerfold.llm.byte_bpe import encoded_digests
from ledgerfold.llm.dart_minhash import keep_one
from ledgerfold.llm.mixing import mix
from ledgerfold.llm.pii import redact
from ledgerfold.llm.quality_rules import keep_good
from ledgerfold.llm.text import small_batches
from ledgerfold.session import scratch_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weighed quality rules keep."""
    small_batches(spark)
    return keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    small_batches(spark)
    return keep_one(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind."""
    return redact(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the target weights of their sources draw them, all at least once."""
    return mix(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the encoded and decoded texts, a row per drawn document."""
    small_batches(spark)
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return encoded_digests(docs, str(path), public_tokenizers.PATTERN)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("source_mix", source_mix),
    ("byte_bpe", encoding),
]

# Expectation-maximisation, boosted trees and byte-pair merges have no form in SQL;
# tests/llm/test_pipeline.py holds the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
