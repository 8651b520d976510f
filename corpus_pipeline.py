"""A corpus from raw documents to packed training sequences.

Every stage takes all rows that the one before it kept. Stages are functions of (spark,
docs, sf_dir); all but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from shelfwise.llm import mixing, packing, quality, repeats, simhash
from shelfwise.llm.common import documents, written


#: Bytes from which a passage counts as repeated. Passages of over 50 words have 300 bytes and
#: more in running text; shorter common phrases stay.
PASSAGE_BYTES = 250


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality.good_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return simhash.one_per_group(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 250 bytes and more that occur elsewhere are cut out of the texts."""
    return repeats.unrepeated_documents(docs, PASSAGE_BYTES)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the numbers that the sources' target weights ask for."""
    return mixing.mixed_documents(docs)


def packing_plan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents with their places in training sequences."""
    return packing.packed_documents(docs, str(public_tokenizers.path("word_bpe_49k.json")))


STAGES = [
    ("quality rules", quality_rules),
    ("SimHash near-dedup", near_duplicates),
    ("suffix-array dedup", repeated_passages),
    ("mixing sources", source_mix),
    ("best-fit packing", packing_plan),
]

#: Byte-level cuts, language statistics and packing are beyond SQL; tests run plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; what a stage returns is written before the next."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
