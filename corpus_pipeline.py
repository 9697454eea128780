"""From raw documents to packed training sequences, in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and returns a table, which is written as Parquet
and read again as the documents of the next one.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendspark.llm import decontaminate, language_id, near_dedup, packing, pii
from trendspark.llm.common import table
from trendspark.llm.queries import TOKENIZER
from trendspark.staging import stage

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose language cannot be told, by models of the labelled ones."""
    model = language_id.train(docs.select(F.col("doc_id").alias("key"), "lang", "text"))
    return language_id.keep_identified(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near duplicates."""
    return near_dedup.drop_near_duplicates(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold an item of the benchmark."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks personal data in the texts and counts their characters anew."""
    masked = pii.mask_personal_data(docs)
    return masked.withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the token ids of what is left into windows of 1024."""
    return packing.pack_documents(docs, public_tokenizers.path(TOKENIZER))


STAGES: list[tuple[str, Stage]] = [
    ("language_id", identify_language),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_benchmark_leaks),
    ("pii", mask_personal_data),
    ("packing", pack_sequences),
]

# language models, edit distances and token ids are beyond SQL; tests hold the rows against brute force
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the documents of a data folder."""
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name)
    return docs
