"""One named query for each operator, over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm import byte_pairs, classifier, collocations, decontaminate, line_dedup, mixing, ngram_join, packing, quality_rules, sharding, substring_dedup, url_filter, vector_codes

Query = Callable[[SparkSession, str], DataFrame]


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ngram_join.join_components(_documents(spark, sf_dir), n=4, percent=85, fold=True)
    return found.select("doc_id", F.col("size").alias("n_shingles"), "component_id")


def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_items(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substring_dedup.remove_repeats(_documents(spark, sf_dir), width=50)
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


URL_RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))


def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(spark.read.parquet(f"{sf_dir}/pages.parquet"), URL_RULES, default="allow")


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classifier.resample(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(_documents(spark, sf_dir), weights=(3, 1, 2), share=1.5, cap=2)
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "rate", "copies")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(_documents(spark, sf_dir)).drop("n_covered", "longest_repeat")


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(_documents(spark, sf_dir), shards=40, overhead=16).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op9_token_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(_documents(spark, sf_dir), room=2048)
    return packed.select(
        "row_id", "n_tokens", "doc_ids", "starts", "cu_seqlens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("positions", 256).alias("positions_sha256")
    )


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = line_dedup.remove_lines(_documents(spark, sf_dir))
    return left.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = byte_pairs.round_trip(_documents(spark, sf_dir))
    return both.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_documents(spark, sf_dir), min_count=10, inside_percent=50, top=2000)


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = vector_codes.compress(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), parts=4, entries=256, rounds=4, scale=1024)
    return coded.select("vec_id", "code", "error", "label_error", F.lit(vector_codes.digest(books)).alias("codebooks_sha256"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_ngram_jaccard_join, op2_benchmark_decontamination, op3_substring_dedup, op4_url_filters, op5_quality_classifier,
        op6_source_mixing, op7_quality_rules, op8_sharding, op9_token_packing, op10_line_dedup,
        op11_byte_bpe, op12_phrase_collocations, op13_vector_codes,
    )
}
