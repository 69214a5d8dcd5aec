"""The registered queries of this package: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from streamtally.llm import audit, bpe, fingerprints, language, leaks, near_dups, oracle, packing, quality, repeats, search, shards, urls, warc
from streamtally.llm.common import documents

Query = Callable[[SparkSession, str], DataFrame]

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


URL_RULES = [
    urls.Rule("org", "/", "allow"),
    urls.Rule("example.org", "/es/", "block"),
    urls.Rule("example.org", "/en/1", "block"),
    urls.Rule("com", "/fr/", "allow"),
    urls.Rule("com", "/de/", "block"),
]


def op8_url_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return urls.judge(pages, urls.train(pages, rules=URL_RULES), URL_RULES)


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(documents(spark, sf_dir), VOCABULARY)


def held_out(doc_id: str = "doc_id"):
    """Rows the language model must not learn from: remainder 2 of the id's checksum."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def op1_weighted_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_fingerprints(documents(spark, sf_dir))


def op2_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return warc.derive(warc.responses(pages, "2024-01-01T00:00:00Z"))


def op3_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shards.shard(documents(spark, sf_dir), shards.metadata_dimensions(), shards=8)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op4_repeat_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.removed_digests(documents(spark, sf_dir)).drop("spans")


def op5_lsh_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dups.near_duplicates(documents(spark, sf_dir), percent=85)


def op6_linear_grouping(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(packing.pieces(documents(spark, sf_dir), VOCABULARY))


def op7_distribution_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return quality.rate(docs, quality.references(docs))


def op10_language_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = language.learn(docs.where(~held_out()))
    return language.predict(docs, model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "ambiguous")


def benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/benchmark.parquet")


def op11_geometric_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(documents(spark, sf_dir), benchmark(spark, sf_dir))


def op12_potential_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op13_window_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks.contamination(documents(spark, sf_dir), benchmark(spark, sf_dir))


QUERIES: dict[str, Query] = {
    "pipeline": corpus_pipeline.run,
    "op1_weighted_sampling": op1_weighted_sampling,
    "op2_warc_derivatives": op2_warc_derivatives,
    "op3_kd_shards": op3_kd_shards,
    "op4_repeat_intervals": op4_repeat_intervals,
    "op5_lsh_forest": op5_lsh_forest,
    "op6_linear_grouping": op6_linear_grouping,
    "op7_distribution_divergence": op7_distribution_divergence,
    "op8_url_trees": op8_url_trees,
    "op9_bpe": op9_bpe,
    "op10_language_codes": op10_language_codes,
    "op11_geometric_search": op11_geometric_search,
    "op12_potential_audit": op12_potential_audit,
    "op13_window_decontamination": op13_window_decontamination,
}
ORACLE: dict[str, str] = oracle.ORACLE
