"""The corpus pipeline: language ID, near-duplicate removal, benchmark decontamination, PII masking, BPE encoding.

Each stage takes the documents its predecessor kept, as a table, and all but the last return the columns of
documents. Rows of null doc_id or null text pass or go as each operator's docstring says.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftfold.llm import bpe, decontam, jaccard, langid, pii
from driftfold.llm.common import materialize, table

#: No SQL expresses the learned and approximate stages; tests hold the pipeline against a plain Python version.
ORACLE_SQL = None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language; those without a letter (`und`) go, and a missing lang is filled in."""
    found = langid.identify(docs, langid.train(docs)).where(F.col("lang_pred") != langid.UNKNOWN)
    return found.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one of smallest doc_id."""
    return jaccard.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    return decontam.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data masked and n_chars as it is then."""
    masked = pii.mask_pii(docs)
    return masked.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their token ids and the text these decode to."""
    coded = bpe.encode_documents(docs, public_tokenizers.path("word_bpe_49k.json"))
    return coded.withColumn("n_tokens", (F.octet_length("ids") / 4).cast("long"))


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("pii", mask_personal_data),
    ("bpe", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each one's result written before the next one reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
