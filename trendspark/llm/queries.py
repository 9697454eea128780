"""Registered queries of the training-data operators: each applies one to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendspark.llm import (
    bpe_transducer,
    chat,
    decontaminate,
    filter_audit,
    fingerprint,
    language_id,
    lexical_search,
    licenses,
    line_dedup,
    near_dedup,
    packing,
    pii,
    token_store,
)
from trendspark.llm.common import table
from trendspark.staging import new_path, stage

TOKENIZER = "byte_bpe_50k.json"
RANKS = "byte_bpe_multi_50k.tiktoken"
CONTROL_TEXT = "</s>[INST] ok [/INST]"


def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), threshold=(85, 100))


def op2_quartile_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.compare_with_next(table(spark, sf_dir, "documents"))


def op3_elias_fano_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "token-ids")
    token_store.write_token_ids(table(spark, sf_dir, "documents"), path, public_tokenizers.path(TOKENIZER), end_id=2)
    return token_store.read_token_ids(spark, path)


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.repeated_passages(table(spark, sf_dir, "documents"))


def op5_chat_prefix_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(CONTROL_TEXT).alias("text"),
    )
    segments = stage(chat.format_conversations(turns.unionByName(control)), "chat")
    return chat.read_back(segments, stage(chat.expand_examples(segments), "examples"))


def op6_cgk_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_pii_deobfuscation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(table(spark, sf_dir, "documents"))


def _held_out() -> F.Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_id.train(docs.where(~_held_out()).select(F.col("doc_id").alias("key"), "lang", "text"))
    return language_id.identify(docs, model).select(
        "doc_id", _held_out().alias("held_out"), "lang_pred", "score", "cross_entropy"
    )


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files below their source and language."""
    files = table(spark, sf_dir, "documents").select(F.concat_ws("/", "source", "lang", "doc_id").alias("path"), "text")
    found = licenses.scan_licenses(files)
    return found.select(F.regexp_extract("path", "[^/]*$", 0).cast("long").alias("doc_id"), *found.columns)


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), window=1024, end_id=0)


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit_filters(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_bpe_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, path = table(spark, sf_dir, "documents"), public_tokenizers.path(RANKS)
    return bpe_transducer.round_trip(docs, path, public_tokenizers.PATTERN).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    registered = (
        op1_minhash_near_dedup, op2_quartile_fingerprint, op3_elias_fano_tokens, op4_line_dedup, op5_chat_prefix_targets,
        op6_cgk_decontamination, op7_pii_deobfuscation, op8_language_id, op9_license_scan, op10_best_fit_packing,
        op11_filter_audit, op12_bpe_transducer, op13_lexical_search,
    )
    return {query.__name__: query for query in registered}
