"""Pipeline over documents: language, near copies, repeated passages, source mix, tokens.

Each stage reads what its predecessor wrote and decides on all of it.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe_tree, langid, mixing, near_dup, suffix_dedup
from tidemark.llm.common import prepare, table
from tidemark.session import run_folder

LEAST_LANGUAGE_SCORE = 0.3
# Passages of over 50 words, whatever their bytes. Strings of op3's 400 bytes go too: not all scripts part words.
PASSAGE_WORDS = 51


def packed(docs: DataFrame, *names: str) -> DataFrame:
    """The named columns, and whole rows as ``_row``: operators and stages add columns without meeting those of the input."""
    return docs.select(*names, F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without letters and those that no learned language explains."""
    prepare(spark)
    model = langid.fit(docs.where(~langid.held_out(F.col("doc_id"))))
    told = packed(docs, "text").select("_row", langid.predict(F.col("text"), model).alias("told"))
    known = (F.col("told.lang_pred") != langid.UNKNOWN) & (F.col("told.score") >= LEAST_LANGUAGE_SCORE)
    return told.where(known).select("_row.*")


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays; of repeated rows, one.

    Where rows share that id, or all lack one, one of them stays. Texts without words are no copies: all stay, repeated
    rows once.
    """
    prepare(spark)
    kept = near_dup.near_duplicates(docs).where("kept").selectExpr(
        "coalesce(id, -9223372036854775808) as _id", "tag as _tag", "group"
    ).distinct()
    own = "group, if(group is null, _id, 0L), if(group is null, _tag, 0L)"
    kept = kept.selectExpr("*", f"row_number() over (partition by {own} order by _id, _tag) as _place").where("_place = 1")
    rows = packed(docs, "doc_id", "text").select(
        "_row", F.coalesce(F.col("doc_id").cast("long"), F.lit(-9223372036854775808)).alias("_id"), near_dup.row_tag(F.col("text")).alias("_tag"),
    )
    # same keys: what is joined is already dealt out as the repeats need it
    rows = rows.join(kept.select("_id", "_tag"), ["_id", "_tag"]).dropDuplicates(["_id", "_tag"])
    return rows.select("_row.*")


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Remove passages of over 50 words or 400 bytes that come more than once; documents with nothing left go.

    Where a cut falls inside a character, the rest of that character goes too; nothing else changes.
    """
    prepare(spark)
    cut = suffix_dedup.drop_repeated(packed(docs, "doc_id", "text"), words=PASSAGE_WORDS)
    cut = cut.where("octet_length(kept_text) > 0 or n_removed = 0")
    text = F.when(F.col("n_removed") == 0, F.col("text")).otherwise(F.col("kept_text"))
    own = {"text": text, "n_chars": F.length(text).cast("long")}
    return cut.select(*[own[c].alias(c) if c in own else F.col(f"_row.`{c}`") for c in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat and leave out documents so that source shares of the text follow the target weights."""
    prepare(spark)
    return mixing.mix(packed(docs, "doc_id", "source", "text")).select("_row.*")


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with a digest of the bytes that they decode to."""
    prepare(spark)
    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    ids = docs.select(
        "doc_id", "lang", "source", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"),
        bpe_tree.round_trip(F.col("text"), path, pattern).alias("done"),
    )
    return ids.select(
        "doc_id", "lang", "source", (F.octet_length("done.ids") / 4).cast("long").alias("n_tokens"), F.col("done.ids").alias("ids"),
        "text_sha256", F.sha2("done.data", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("language", keep_known_languages),
    ("near_copies", keep_one_of_near_copies),
    ("repeated_passages", cut_repeated_passages),
    ("mix", mix_sources),
    ("tokens", encode_texts),
]

# Learning, hashing and tokenizing have no SQL; tests compare each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        folder = run_folder(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return STAGES[-1][1](spark, docs, sf_dir)
