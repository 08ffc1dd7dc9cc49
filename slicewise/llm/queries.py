"""The operators on the driver's tables, with production parameters: one query for each operator."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slicewise.llm import bpe, chat, embedding_dedup, html_text, packing, personal, quality, simhash, substring_dedup, suffix_dedup, token_counts, vector_codes, whitening
from slicewise.llm.common import table


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    cut = substring_dedup.substring_dedup(docs, window=13, block=7)
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extracted(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op3_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffix_dedup.repeated_passages(docs, window=50, gram=12).withColumnRenamed("first_id", "first_doc_id")


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    placed = packing.packed(docs, public_tokenizers.path("word_bpe_49k.json"), capacity=2048)
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts.token_counts(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)


def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, max_bits=4)
    return found.select("doc_id", F.lower(F.lpad(F.hex(F.col("fingerprint")[0]), 16, "0")).alias("fingerprint"), "component_id")


def op7_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.formatted(table(spark, sf_dir, "conversations"))


def op8_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_vectors(table(spark, sf_dir, "embeddings"), least_cosine=0.95)


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rated = quality.quality(table(spark, sf_dir, "documents"))
    columns = ["doc_id", *quality.BASE, "base_failed", "kept", "perplexity", "copied", "lower", "upper"]
    return rated.select(*columns)


def op10_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe.encoded(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compressed(table(spark, sf_dir, "embeddings"), parts=16, entries=64, rounds=2, scale=256)


def op12_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal.found(table(spark, sf_dir, "documents").select("doc_id", "text"))
    shown = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    counts = [F.expr(f"cast(size(filter(base, s -> s.kind = '{k}')) as long) n_{k}") for k in personal.BASE]
    return found.select("doc_id", *counts, F.sha2(shown(F.col("base")), 256).alias("base_sha256"), shown(F.col("spans")).alias("spans"))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings"), components=8, scale=1024, shift=100_000)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [f for name, f in globals().items() if name.startswith("op") and callable(f)]
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {
        "op1_substring_dedup": substring_dedup.SQL,
        "op2_html_extraction": html_text.SQL,
        "op3_suffix_array_dedup": suffix_dedup.SQL,
        "op7_chat_formatting": chat.SQL,
        "op8_embedding_near_dedup": embedding_dedup.SQL,
        "op11_vector_codes": vector_codes.SQL,
    }
