"""From documents to packed training sequences: language ID, quality rules, near-dedup, repeated strings, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again
as the next stage's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streamtally.llm import language, near_dups, packing, quality, repeats
from streamtally.session import scratch_dir

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
SIMILARITY = 80  # per cent of shared five-word shingles from which documents are near copies

ORACLE_SQL = None  # the stages are trained, hashed or packed; tests hold each against brute force


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which no language can be told go; `lang` of the others becomes what a clear prediction says.

    Rejected are texts that are null or have no letter, and ambiguous ones without a learned label.
    """
    learned = docs.where(F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 != 2, F.lit(True)))
    return language.identified(docs, language.learn(learned))


def apply_quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or diverge from their language's histograms go."""
    return quality.accepted(docs, quality.references(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group stays."""
    groups = near_dups.near_duplicates(docs, SIMILARITY)
    gone = groups.where(~F.col("kept")).select(F.col("doc_id").alias("gone")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["gone"], "left_anti")


def remove_repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of 50 bytes that an earlier document has are cut out of the texts."""
    return repeats.cleaned(docs).withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2048 tokens with their sequence and place in it."""
    return packing.pack(packing.pieces(docs, VOCABULARY))


STAGES = [
    ("language_id", identify_language),
    ("quality_rules", apply_quality_rules),
    ("near_dedup", drop_near_duplicates),
    ("suffix_array_dedup", remove_repeated_strings),
    ("best_fit_packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
