"""Registered queries of the corpus operators, and their SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ledgerfold.llm.byte_bpe import encoded_digests
from ledgerfold.llm.dart_minhash import classes_sql, near_duplicates
from ledgerfold.llm.epsilon_join import linked_vectors, links_sql
from ledgerfold.llm.licenses import license_labels
from ledgerfold.llm.mixing import mixing_report, mixing_sql
from ledgerfold.llm.periodic_runs import runs_report
from ledgerfold.llm.pii import pii_report
from ledgerfold.llm.prefix_trie import trie_report, trie_sql
from ledgerfold.llm.quality_mil import quality_scores
from ledgerfold.llm.quality_rules import quality_rules
from ledgerfold.llm.suffix_trees import repeats_report, repeats_sql
from ledgerfold.llm.text import small_batches
from ledgerfold.llm.token_counts import token_counts
from ledgerfold.llm.toxicity import toxicity_scores

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def _token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return token_counts(_table(spark, sf_dir, "documents"), str(path))


def _quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(_table(spark, sf_dir, "documents"))


def _byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return encoded_digests(
        _table(spark, sf_dir, "documents"), str(path), public_tokenizers.PATTERN
    )


def _toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def _near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"))


def _embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linked_vectors(_table(spark, sf_dir, "embeddings"))


def _licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_labels(_table(spark, sf_dir, "documents"))


def _pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_report(_table(spark, sf_dir, "documents"))


def _mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing_report(_table(spark, sf_dir, "documents"))


def _runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs_report(_table(spark, sf_dir, "documents"))


def _trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie_report(_table(spark, sf_dir, "conversations"))


def _repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats_report(_table(spark, sf_dir, "documents"))


def queries() -> dict[str, Query]:
    return {
        "op1_quality_attention": _quality,
        "op2_token_counts": _token_counts,
        "op3_quality_rules": _quality_rules,
        "op4_toxicity_windows": _toxicity,
        "op5_dart_minhash": _near_duplicates,
        "op6_epsilon_grid_join": _embeddings,
        "op7_license_diagonals": _licenses,
        "op8_byte_bpe": _byte_bpe,
        "op9_pii_boosting": _pii,
        "op10_temperature_mixing": _mixing,
        "op11_recompression_runs": _runs,
        "op12_prefix_trie": _trie,
        "op13_suffix_trees": _repeats,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op5_dart_minhash": classes_sql(),
        "op6_epsilon_grid_join": links_sql(),
        "op10_temperature_mixing": mixing_sql(),
        "op12_prefix_trie": trie_sql(),
        "op13_suffix_trees": repeats_sql(),
    }
