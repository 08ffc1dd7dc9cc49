"""A corpus pipeline of the training-data operators: quality rules, near-dedup, substring dedup, packing."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slicewise.llm import packing, quality, simhash, substring_dedup
from slicewise.llm.common import stored, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or their language's perplexity band reject go; the rest are unchanged.

    Null and empty texts have no words and go. A null language is a language of its own. Verdicts are by
    text and language, so rows with a null or repeated id are judged like others. An empty table stays empty;
    further columns, whatever their names, are kept as they are.
    """
    return quality.keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays, the one with the smallest doc_id.

    Near-duplicates have five-word shingle sets of a Jaccard similarity of 0.8 or more. Documents meet on
    their rarest shingles, as many that no such pair can miss. Fingerprints of 256 bits over the distinct
    shingles propose links there: about 39 bits differ at 0.8 and about 128 between unlike texts, and pairs
    within 84 (eight deviations more than 39, five less than 128) are verified by their shingles. So few
    unlike texts are linked that groups of proposed links don't grow together in a large table.

    Verdicts are by doc_id and text: unlike texts with one id are documents of their own; rows that repeat
    both share a verdict. A null id is larger than every other. Null and empty texts are one group. An empty
    table stays empty; further columns, whatever their names, are kept as they are.
    """
    return simhash.keep_first(docs, shingle=5, lanes=4, max_bits=84, similarity=0.8)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words and more that a document with a smaller doc_id has too are cut out.

    A document that loses words has the others joined by one space as its text, and its n_chars is
    counted anew; one that loses all goes. Other documents are unchanged, null and empty texts too. A null
    doc_id is larger than every other; rows with equal ids don't cut each other. An empty table stays empty;
    further columns, whatever their names, are kept as they are.
    """
    own = ("doc_id", "text", "n_chars")
    names = [c if c in own else f"column{i}" for i, c in enumerate(docs.columns)]  # the operator adds columns
    cut = substring_dedup.substring_dedup(docs.toDF(*names), window=50, block=25)
    changed = F.col("n_removed") > 0
    return (
        cut.where(~changed | (F.col("n_removed") < F.col("n_words")))
        .withColumn("text", F.when(changed, F.col("kept_text")).otherwise(F.col("text")))
        .withColumn("n_chars", F.when(changed, F.length("kept_text").cast("long")).otherwise(F.col("n_chars")))
        .select(*names).toDF(*docs.columns)
    )


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents packed into sequences of at most 2048 tokens; one row for each piece, with its ids.

    A null or empty text is one piece with the end id alone. Rows with a null or repeated doc_id are packed
    as rows. An empty table gives none. Columns but doc_id and text are not part of the result.
    """
    return packing.packed(docs, public_tokenizers.path("word_bpe_49k.json"), capacity=2048, with_ids=True)


STAGES = [("quality_rules", quality_rules), ("near_dedup", near_dedup), ("substring_dedup", repeats), ("packing", pack)]

#: No stage's arithmetic is SQL (language model, fingerprints, tokenizer); tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``, each to what the one before it kept."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs
