"""Corpus pipeline: from raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next stage's ``docs``.  All stages
but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from order_mart.llm.common import read_table, stage
from order_mart.llm.exact_dedup import exact_dedup
from order_mart.llm.ngram_join import jaccard_classes
from order_mart.llm.packing import pack_documents
from order_mart.llm.quality_bands import quality_bands
from order_mart.llm.rindex_dedup import remove_repeats

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or leave their compression band go."""
    return quality_bands(docs.select(*COLUMNS)).filter("kept").select(*COLUMNS)


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the smallest doc_id stays."""
    return exact_dedup(docs.select(*COLUMNS)).filter("kept").select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked texts (five-word shingles, similarity 0.8) the
    smallest doc_id stays; texts without words are linked with nothing and
    stay.  Rows without a doc_id stay if one of them has no linked id."""
    classes = jaccard_classes(docs.select("doc_id", "text"), width=5, percent=80)
    stays = classes.filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("_stays")).distinct()
    return docs.select(*COLUMNS).join(stays, F.col("doc_id").eqNullSafe(F.col("_stays")), "left_semi")


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 200 bytes or more that occur elsewhere are cut out; a
    document of nothing else stays with an empty text."""
    left = remove_repeats(docs.select(*COLUMNS))
    return left.select("doc_id", F.col("kept_text").alias("text"), "lang", "source",
                       F.char_length("kept_text").cast("long").alias("n_chars"))


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces and their places in sequences of 4096 tokens."""
    return pack_documents(docs.select("doc_id", "text"), remember=False)


STAGES = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_duplicates),
    ("ngram_jaccard_join", near_duplicates),
    ("suffix_array_dedup", repeated_passages),
    ("best_fit_packing", packed_sequences),
]

#: Compression ratios, tokenisers and packing are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the whole documents table."""
    docs = read_table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
