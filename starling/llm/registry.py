"""Registered queries of this subpackage and the SQL that checks them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import (decontaminate, language, line_dedup, mixing, negatives, pii, prefix_trie, quality_fm, quality_rules, simhash, tokens, toxicity,
               wrappers)
from .common import read_table


def op1_quality_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_fm.quality_digest(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.language_digest(read_table(spark, sf_dir, "documents"))


def op3_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrappers.pages_digest(read_table(spark, sf_dir, "pages"))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_digest(read_table(spark, sf_dir, "documents"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_digest(read_table(spark, sf_dir, "documents"))


def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_digest(read_table(spark, sf_dir, "documents"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fresh cache per call: every call encodes all distinct texts, so its result and cost depend on the table alone."""
    return tokens.count_tokens(read_table(spark, sf_dir, "documents"), tokens.fresh_cache_path(spark))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.rules_digest(read_table(spark, sf_dir, "documents"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.lines_digest(read_table(spark, sf_dir, "documents"))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks_digest(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives.mine(read_table(spark, sf_dir, "embeddings"))


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_digest(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(read_table(spark, sf_dir, "conversations"))


QUERIES = {f.__name__: f for f in (op1_quality_fm, op2_language_id, op3_page_text, op4_pii, op5_simhash, op6_mix_sources, op7_token_counts,
                                  op8_quality_rules, op9_line_dedup, op10_decontaminate, op11_hard_negatives, op12_toxicity,
                                  op13_prefix_trie)}

ORACLE = {"op6_mix_sources": mixing.ORACLE_MIX, "op8_quality_rules": quality_rules.ORACLE_RULES,
          "op11_hard_negatives": negatives.ORACLE_NEGATIVES, "op13_prefix_trie": prefix_trie.ORACLE_TRIE}
