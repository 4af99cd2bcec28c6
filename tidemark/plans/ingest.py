"""Files of raw posts to one clean table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.clean import clean_posts
from tidemark.session import configure, sized_shuffles, stored_bytes
from tidemark.sources import posts as sources
from tidemark.sources import tables

NOTE = "Parquet partitioned by date."


def ingest(
    spark: SparkSession,
    input_dir: str,
    out_dir: str,
    scope: str = "file",
    extras: str | None = None,
    strip_brackets: bool = False,
    csv_multiline: bool = True,
    json_layout: str = "auto",
    csv_layout: str = "auto",
    broken: str = "fail",
) -> DataFrame:
    """Read, clean, drop repeats, write ``posts`` and its metadata; returns the run summary.

    One shuffle for repeats and one to gather dates for the write.
    """
    configure(spark)
    target = f"{out_dir.rstrip('/')}/posts"
    with sized_shuffles(spark, stored_bytes(spark, input_dir)):
        raw = sources.read_posts(spark, input_dir, extras, csv_multiline, json_layout, csv_layout, broken)
        tables.write_posts(clean_posts(raw, scope, strip_brackets=strip_brackets), target)
    return write_metadata(spark, input_dir, out_dir, target)


def write_metadata(spark: SparkSession, input_dir: str, out_dir: str, posts_path: str) -> DataFrame:
    """``ingest_files`` (one row per file) and ``ingest_metadata`` (one row per run)."""
    base = out_dir.rstrip("/")
    written = spark.read.parquet(posts_path).select("source_file")
    per_file = tables.rows_per_file(sources.discover_files(spark, input_dir), written)
    tables.write_json(per_file, f"{base}/ingest_files")
    summary = tables.run_summary(
        spark.read.schema("name string, rows bigint").json(f"{base}/ingest_files"), posts_path, NOTE
    )
    tables.write_json(summary.coalesce(1), f"{base}/ingest_metadata")
    return spark.read.json(f"{base}/ingest_metadata")


def read_clean(spark: SparkSession, posts_path: str) -> DataFrame:
    """The written posts; ``date`` is text again, and filters on it still prune folders."""
    return spark.read.parquet(posts_path).withColumn("date", F.col("date").cast("string"))
