"""The corpus queries by name; each runs its operator over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from marketlake.llm.bpe import bpe_report
from marketlake.llm.chat_format import ORACLE as PREFERENCES
from marketlake.llm.chat_format import preference_report
from marketlake.llm.common import table
from marketlake.llm.conversation_trie import ORACLE as TRIE
from marketlake.llm.conversation_trie import conversation_trie
from marketlake.llm.decontamination import ORACLE as DECONTAMINATION
from marketlake.llm.decontamination import decontamination_report
from marketlake.llm.exact_topk import ORACLE as TOP_K
from marketlake.llm.exact_topk import top_k_report
from marketlake.llm.licenses import license_report
from marketlake.llm.merkle import ORACLE as MANIFEST
from marketlake.llm.merkle import merkle_report
from marketlake.llm.pii import pii_report
from marketlake.llm.quality_rules import quality_report
from marketlake.llm.secrets import ORACLE as SECRETS
from marketlake.llm.secrets import secret_report
from marketlake.llm.simhash import simhash_report
from marketlake.llm.substring_dedup import substring_report
from marketlake.llm.warc import ORACLE as ARCHIVES
from marketlake.llm.warc import warc_report


def op1_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_report(table(spark, sf_dir, "documents"))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_report(table(spark, sf_dir, "documents"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_report(table(spark, sf_dir, "documents"))


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_report(table(spark, sf_dir, "documents"))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_report(table(spark, sf_dir, "documents"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_warc_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_report(table(spark, sf_dir, "pages"))


def op8_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_report(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_preference_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preference_report(table(spark, sf_dir, "conversations"))


def op11_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k_report(table(spark, sf_dir, "embeddings"))


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(table(spark, sf_dir, "conversations"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle_report(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_pii_pseudonyms": op1_pii_pseudonyms,
    "op2_secret_scan": op2_secret_scan,
    "op3_license_scan": op3_license_scan,
    "op4_simhash_near_dedup": op4_simhash_near_dedup,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_decontamination": op6_decontamination,
    "op7_warc_archives": op7_warc_archives,
    "op8_bpe_round_trip": op8_bpe_round_trip,
    "op9_quality_rules": op9_quality_rules,
    "op10_preference_pairs": op10_preference_pairs,
    "op11_exact_topk": op11_exact_topk,
    "op12_conversation_trie": op12_conversation_trie,
    "op13_merkle_manifest": op13_merkle_manifest,
}
ORACLES: dict[str, str] = {
    "op2_secret_scan": SECRETS,
    "op6_decontamination": DECONTAMINATION,
    "op7_warc_archives": ARCHIVES,
    "op10_preference_pairs": PREFERENCES,
    "op11_exact_topk": TOP_K,
    "op12_conversation_trie": TRIE,
    "op13_merkle_manifest": MANIFEST,
}
