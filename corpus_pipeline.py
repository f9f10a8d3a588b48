"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read again by the next.

Rows that a filtering stage rejects are gone; the others keep their columns. The personal data stage replaces the text
and its length. The last stage returns token counts and digests. Stages stand empty tables, NULLs and repeated rows as
their operators define; repeated rows end in the near-duplicate stage, which keeps one row of each group. What an
operator stores on the way goes when its stage is written, and a stage's rows when the next stage's are.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.llm.bpe import bpe_report
from marketlake.llm.common import remove, table, temporary
from marketlake.llm.decontamination import clean_documents
from marketlake.llm.pii import pseudonymize
from marketlake.llm.quality_rules import good_documents
from marketlake.llm.simhash import first_of_each
from marketlake.session import scratch_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return good_documents(docs, table(spark, sf_dir, "labels"))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return first_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return clean_documents(docs, table(spark, sf_dir, "benchmark"))


def pii_pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with pseudonyms; ``n_chars`` follows a text that changed."""
    found = pseudonymize(docs)
    n_chars = F.when(F.size("pii") > 0, F.length("text").cast("bigint")).otherwise(F.col("n_chars"))
    return found.select(*[n_chars.alias(c) if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns])


def bpe_round_trip(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe_report(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", simhash_near_dedup),
    ("decontamination", decontamination),
    ("pii_pseudonyms", pii_pseudonyms),
    ("bpe_round_trip", bpe_round_trip),
]

#: Fingerprints, pseudonyms and tokens are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        with temporary(spark):
            kept = stage(spark, docs, sf_dir)
            kept.write.parquet(path)
        docs = spark.read.schema(kept.schema).parquet(path)
        if before:
            remove(spark, before)
        before = path
    return docs
