"""The queries of this subpackage's operators, over whole tables and with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import bpe_codec, byte_cnn, chunk_dedup, id_store, language_id, line_templates, oracles, repetition_rules, severity, simhash_dedup, template_decontam
from .common import table


def op1_template_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return template_decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.train_and_identify(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op3_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op4_repetition_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition_rules.score_repetition(table(spark, sf_dir, "documents"))


def op5_byte_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_cnn.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_templates.drop_recurring_lines(table(spark, sf_dir, "documents")).select("doc_id", "text", "n_lines", "n_dropped")


def op7_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_codec.encode_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op8_id_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = id_store.write_store(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return id_store.read_store(spark, store)


def op9_severity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return severity.score_severity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_chunk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_dedup.repeated_passages(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_template_decontam, op2_language_id, op3_simhash_dedup, op4_repetition_rules, op5_byte_cnn, op6_line_templates, op7_bpe_codec, op8_id_store, op9_severity, op10_chunk_dedup)}


def oracle_sql() -> dict[str, str]:
    return {"op1_template_decontam": oracles.DECONTAMINATION, "op4_repetition_rules": oracles.REPETITION, "op6_line_templates": oracles.LINE_TEMPLATES}
