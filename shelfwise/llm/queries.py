"""Registered queries of the document operators, each over its whole table."""

from __future__ import annotations

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm import (
    divergence,
    embeddings,
    language,
    licenses,
    mixing,
    packing,
    quality,
    repeats,
    resampling,
    scoring,
    sharding,
    simhash,
    token_counts,
)
from shelfwise.llm.common import documents, numbered
from shelfwise.registry import Query

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLE[name] = sql
        return function

    return register


@query("op1_simhash_near_dedup")
def simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = numbered(documents(spark, sf_dir), "documents", "doc_id", "text")
    return simhash.near_duplicates(docs).select("doc_id", "fingerprint", "component_id")


@query("op2_remove_repeats")
def remove_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.without_repeats(documents(spark, sf_dir)).drop("kept")


@query("op3_pack")
def pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    return packing.packed_documents(documents(spark, sf_dir), str(tokenizer))


@query("op4_license_scan", licenses.oracle_sql())
def license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Lists become text, which both engines write alike.
    return licenses.scan(documents(spark, sf_dir)).withColumn(
        "line_licenses", F.array_join("line_licenses", ",")
    )


@query("op5_language_id")
def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(documents(spark, sf_dir))


@query("op6_embedding_near_dedup")
def embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


@query("op7_lm_scores")
def lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.scored(documents(spark, sf_dir))


@query("op8_quality_rules")
def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.assess(documents(spark, sf_dir).select("doc_id", "lang", "text")).drop(
        "lang", "text"
    )


@query("op9_mix_sources")
def mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken_words(documents(spark, sf_dir))


@query("op10_shard")
def shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.sharded(documents(spark, sf_dir))


@query("op11_token_counts")
def count_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    return token_counts.token_counts(documents(spark, sf_dir), str(tokenizer))


@query("op12_source_divergence", divergence.oracle_sql())
def source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(documents(spark, sf_dir))


@query("op13_importance_resampling", resampling.oracle_sql())
def importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return resampling.resampled(documents(spark, sf_dir), benchmark)


@query("pipeline", corpus_pipeline.ORACLE_SQL)
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)
