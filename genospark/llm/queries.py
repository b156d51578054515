"""One query per operator, over its whole table, and the SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from genospark.llm import (bm25_packing, byte_pairs, decontamination, exact_dedup, hidden_markov, html_extraction,
                           importance_resampling, language_mixture, ngram_jaccard, sharded_lloyd, suffix_dedup,
                           token_alignment, url_filters)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(url_filters.RULES, "host string, path string, verdict string")
    return url_filters.judge_urls(table(spark, sf_dir, "pages"), rules)


def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op5_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance_resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extraction.extract_pages(table(spark, sf_dir, "pages"))


def op7_bm25_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bm25_packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def remainder(column: str, divisor: int) -> Column:
    """crc32 of the column as text, modulo ``divisor``; null counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))), F.lit(divisor))


def op3_hidden_markov(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("train", remainder("doc_id", 7) != 2)
    return hidden_markov.score_texts(docs, "train")


def op8_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard.near_copies(table(spark, sf_dir, "documents"))


def op9_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), keep_text=False)


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", remainder("doc_id", 4) == 2)
    model = language_mixture.fit(docs.where("NOT held_out"))
    return language_mixture.identify(docs, model, keep=["held_out"])


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.link_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                                       public_tokenizers.path("piece_bpe_32k.model"))


def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharded_lloyd.Lloyd(table(spark, sf_dir, "embeddings"), k=16, rounds=3, dims=64, scale=64, seed=1).assigned()


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    encoded = byte_pairs.encode(table(spark, sf_dir, "documents"), *vocabulary)
    return byte_pairs.decode(encoded, *vocabulary).select(
        "doc_id", F.expr("octet_length(ids) div 4").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_url_filters": op1_url_filters,
    "op2_benchmark_decontamination": op2_benchmark_decontamination,
    "op3_hidden_markov": op3_hidden_markov,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_importance_resampling": op5_importance_resampling,
    "op6_html_extraction": op6_html_extraction,
    "op7_bm25_packing": op7_bm25_packing,
    "op8_ngram_jaccard_join": op8_ngram_jaccard_join,
    "op9_suffix_array_dedup": op9_suffix_array_dedup,
    "op10_language_id": op10_language_id,
    "op11_token_alignment": op11_token_alignment,
    "op12_centroid_clustering": op12_centroid_clustering,
    "op13_byte_bpe": op13_byte_bpe,
}

ORACLE: dict[str, str] = {
    "op1_url_filters": url_filters.ORACLE_SQL,
    "op2_benchmark_decontamination": decontamination.ORACLE_SQL,
    "op4_exact_dedup": exact_dedup.ORACLE_SQL,
    "op12_centroid_clustering": sharded_lloyd.oracle_sql(),
}
