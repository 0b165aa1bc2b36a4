"""From raw documents to packed training sequences, in stages.

Each stage is ``(name, function)``; the function takes the session, the documents its predecessor
kept and the folder of the tables, and returns a DataFrame. Between two stages the documents are
written as Parquet and read again. All stages but the last return the columns of documents.

What a stage returns is computed when it is written, so every stage bounds the Arrow batches of the
session (``batches.bound_batches``) and leaves that bound set.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from pagefolio.llm import batches, language_id, near_duplicates, packing, personal_data, quality_rules
from pagefolio.sources.scratch import written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that fail a quality rule."""
    batches.bound_batches(spark)
    return quality_rules.kept_documents(docs)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents in none of the languages learned from what the first stage kept, if any were."""
    batches.bound_batches(spark)
    return language_id.documents_in(docs, language_id.train(docs))


def deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group of near duplicates."""
    batches.bound_batches(spark)
    return near_duplicates.without_near_duplicates(docs)


def masked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data in the texts by its kind."""
    batches.bound_batches(spark)
    return personal_data.without_personal_data(docs, personal_data.train(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their sequence and offset."""
    batches.bound_batches(spark)
    return packing.packed_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality rules", quality),
    ("language ID", language),
    ("near duplicates", deduplicated),
    ("personal data", masked),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}
# Learned models take part, which SQL cannot express; the tests compare with a plain version.
ORACLE_SQL = None
ORACLES: dict[str, str] = {}
