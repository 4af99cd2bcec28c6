"""Registered queries of the corpus operators and their DuckDB SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    bpe_tree, filter_audit, langid, mixing, near_dup, oracle, quality_llr, resampling, sharding, suffix_dedup,
    token_count, token_store, topk, warc,
)
from tidemark.llm.common import prepare, table


def quality(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(prepare(spark), sf, "documents")
    trusted = table(spark, sf, "labels").where("quality = 1 and toxic = 0")
    return quality_llr.judge(docs, quality_llr.fit_ratios(docs, trusted))


def mixed_sources(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(prepare(spark), sf, "documents").select("doc_id", "source", "text")
    return mixing.mix(docs).select(
        "doc_id", "source", F.col("_copy").cast("long").alias("copy"), F.col("_order").alias("place"),
        F.octet_length("text").cast("long").alias("n_bytes"),
    )


def suffix_array(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(prepare(spark), sf, "documents").select("doc_id", "text")
    return suffix_dedup.drop_repeated(docs).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"),
        F.octet_length("kept").cast("long").alias("n_kept"), F.col("kept_text").alias("text"),
    )


def warc_archives(spark: SparkSession, sf: str) -> DataFrame:
    files = warc.write_warc(table(prepare(spark), sf, "pages"))
    return warc.read_warc(files).select(
        warc.page_of(F.col("record_id")).alias("page_id"), "payload_bytes", F.col("digest").alias("payload_digest"),
        "record_type", warc.page_of(F.col("refers_to")).alias("refers_to"),
    )


def languages(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(prepare(spark), sf, "documents")
    held = langid.held_out(F.col("doc_id"))
    model = langid.fit(docs.where(~held))
    return docs.select(
        "doc_id", held.alias("held_out"), langid.predict(F.col("text"), model).alias("p")
    ).select("doc_id", "held_out", "p.*")


def byte_bpe(spark: SparkSession, sf: str) -> DataFrame:
    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    done = table(prepare(spark), sf, "documents").select(
        "doc_id", bpe_tree.round_trip(F.col("text"), path, pattern).alias("done")
    )
    return done.select(
        "doc_id", (F.octet_length("done.ids") / 4).cast("long").alias("n_tokens"), F.sha2("done.ids", 256).alias("ids_sha256"),
        F.sha2("done.data", 256).alias("decoded_sha256"),
    )


def stored_ids(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(prepare(spark), sf, "documents")
    manifest = token_store.write_store(docs, public_tokenizers.path("word_bpe_49k.json"))
    return token_store.read_store(manifest).select(
        "doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32")
    )


def near_copies(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(prepare(spark), sf, "documents")
    return near_dup.near_duplicates(docs).select(
        F.col("id").alias("doc_id"), "n_shingles", "component_id", "kept"
    )


def best_vectors(spark: SparkSession, sf: str) -> DataFrame:
    vectors = table(prepare(spark), sf, "embeddings")
    return topk.top_k(vectors, F.col("vec_id") % 50 == 0)


def token_counts(spark: SparkSession, sf: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    counted = table(prepare(spark), sf, "documents").select(
        "doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        token_count.count_tokens(F.col("text"), path).alias("n_tokens"),
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > 1024)


def towards_benchmark(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(prepare(spark), sf, "documents")
    return resampling.resample(docs, table(spark, sf, "benchmark"))


def filters_in_any_order(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(prepare(spark), sf, "documents")
    return filter_audit.audit(docs, table(spark, sf, "labels"))


def shards(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(prepare(spark), sf, "documents").select("doc_id", "text")
    return sharding.place(docs, [1.0] * 40)


QUERIES = {
    "op1_quality_llr": quality,
    "op2_mixing": mixed_sources,
    "op3_suffix_dedup": suffix_array,
    "op4_warc": warc_archives,
    "op5_language": languages,
    "op6_byte_bpe": byte_bpe,
    "op7_token_store": stored_ids,
    "op8_near_duplicates": near_copies,
    "op9_top_vectors": best_vectors,
    "op10_token_counts": token_counts,
    "op11_resampling": towards_benchmark,
    "op12_filter_audit": filters_in_any_order,
    "op13_sharding": shards,
}

ORACLES = oracle.ORACLES
