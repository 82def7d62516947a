"""Queries and SQL of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cellgrain.llm import hilbert, maxent, mcd, media, mixing, resample, shards, simhash, sptok, trie, urlbloom, warc, zstdclf
from cellgrain.llm.common import parquet


def of(table: str, operator: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: operator(parquet(spark, sf_dir, table))


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zstdclf.classify(parquet(spark, sf_dir, "documents"), parquet(spark, sf_dir, "labels"))


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resampled_documents(parquet(spark, sf_dir, "documents"), parquet(spark, sf_dir, "benchmark"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    import corpus_pipeline

    return {
        "op1_media_columns": of("documents", media.media_features),
        "op2_mcd_outliers": of("documents", mcd.outlier_rules),
        "op3_compression_classifier": op3,
        "op4_prefix_shards": of("documents", shards.shard_documents),
        "op5_hilbert_packing": of("documents", hilbert.packed_pieces),
        "op6_url_bloom_filter": of("pages", urlbloom.url_verdicts),
        "op7_sentencepiece_scan": of("documents", sptok.encoded_texts),
        "op8_warc_archives": of("pages", warc.archived_pages),
        "op9_simhash_tiles": of("documents", simhash.near_copies),
        "op10_maxent_scores": of("documents", maxent.language_scores),
        "op11_fair_queueing": of("documents", mixing.mixed_documents),
        "op12_importance_resampling": op12,
        "op13_conversation_trie": of("conversations", trie.conversation_trie),
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    return {"op2_mcd_outliers": mcd.sql(), "op4_prefix_shards": shards.sql(), "op6_url_bloom_filter": urlbloom.sql(), "op8_warc_archives": warc.SQL, "op11_fair_queueing": mixing.sql(), "op12_importance_resampling": resample.sql(), "op13_conversation_trie": trie.sql()}
