"""The queries of the text operators, each over its whole table, and their DuckDB SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from driftfold.llm import ann, bpe, decontam, jaccard, langid, lm, pii, secrets, sharding, tokenfile
from driftfold.llm.common import table


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.held_out_prediction(table(spark, sf_dir, "documents"))


def op2_bpe(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    return bpe.bpe_digest(table(spark, sf_dir, "documents"), path or public_tokenizers.path("word_bpe_49k.json"))


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_documents(table(spark, sf_dir, "documents"))


def op4_token_output(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    return tokenfile.token_index(table(spark, sf_dir, "documents"), path or public_tokenizers.path("word_bpe_49k.json"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.linked_components(table(spark, sf_dir, "documents"))


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return secrets.scan_secrets(docs, secrets.trained_models(docs))


def op9_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest_neighbours(table(spark, sf_dir, "embeddings"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_digest(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (op1_language_id, op2_bpe, op3_lm_scoring, op4_token_output, op5_decontamination, op6_sharding, op7_jaccard_join, op8_secrets, op9_nearest_neighbours, op10_pii)
    return {f.__name__: f for f in own} | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    return {"op6_sharding": sharding.sharding_sql(), "op7_jaccard_join": jaccard.JACCARD_SQL}
