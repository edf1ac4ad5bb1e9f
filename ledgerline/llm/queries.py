"""Registered queries of the numbered operators: one per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (chat_format, conversation_repair, decontaminate, hard_negatives, language_id, quality_classifier,
               quality_rules, sentencepiece_codec, simhash_dedup, substring_dedup, suffix_dedup, superminhash_dedup, token_counts)
from .common import prepare, table

WORD_BPE, PIECE_BPE = "word_bpe_49k.json", "piece_bpe_32k.model"
Builder = Callable[[SparkSession, str], DataFrame]


def tokenizer(name: str) -> str:
    """Place of a vocabulary file; the same on the driver and on the executors."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _over(name: str, operator: Callable[[DataFrame], DataFrame]) -> Builder:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepare(spark)
        return operator(table(spark, sf_dir, name))
    run.__doc__ = operator.__doc__
    return run


def _op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of whole ``documents``, learned from ``labels``."""
    prepare(spark)
    return quality_classifier.op3(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def _op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of ``benchmark`` inside whole ``documents``."""
    prepare(spark)
    return decontaminate.op8(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def queries() -> dict[str, Builder]:
    return {
        "op1_substring_dedup": _over("documents", substring_dedup.op1),
        "op2_token_counts": _over("documents", lambda docs: token_counts.op2(docs, tokenizer(WORD_BPE))),
        "op3_quality_classifier": _op3,
        "op4_suffix_array_dedup": _over("documents", suffix_dedup.op4),
        "op5_quality_rules": _over("documents", quality_rules.op5),
        "op6_sentencepiece": _over("documents", lambda docs: sentencepiece_codec.op6(docs, tokenizer(PIECE_BPE))),
        "op7_language_id": _over("documents", language_id.op7),
        "op8_benchmark_decontamination": _op8,
        "op9_chat_formatting": _over("conversations", chat_format.op9),
        "op10_simhash_near_dedup": _over("documents", simhash_dedup.op10),
        "op11_conversation_repair": _over("conversations", conversation_repair.op11),
        "op12_hard_negatives": _over("embeddings", hard_negatives.op12),
        "op13_minhash_near_dedup": _over("documents", superminhash_dedup.op13),
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_substring_dedup": substring_dedup.ORACLE,
        "op5_quality_rules": quality_rules.ORACLE,
        "op8_benchmark_decontamination": decontaminate.ORACLE,
        "op9_chat_formatting": chat_format.ORACLE,
        "op12_hard_negatives": hard_negatives.ORACLE,
    }
