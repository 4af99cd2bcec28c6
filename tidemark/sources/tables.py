"""Parquet tables of the flow, run metadata and per-hashtag files."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.clean import drop_incomplete
from tidemark.session import release, remove, run_folder

# A table is dealt out by hashtag in so many slices at most, of so many stored bytes at least.
SLICES = 16
SLICE_BYTES = 32 * 1024 * 1024

# The columns the feature stage reads.
MINIMAL_COLUMNS = (
    "uid", "timestamp", "content", "likes", "retweets", "replies",
    "_hashtags_list", "hashtag_primary", "username",
)


def write_posts(posts: DataFrame, path: str, mode: str = "error") -> int:
    """Write clean posts as Snappy Parquet by date and return the number of rows.

    Rows are rebalanced by date first: a date fills few files, and AQE splits a
    date that is far larger than the others. The count is taken in the writing
    tasks, behind the shuffle, where a repeated task is not counted twice.
    """
    counted = Observation()
    (
        posts.hint("rebalance", F.col("date"))
        .observe(counted, F.count(F.lit(1)).alias("rows"))
        .write.mode(mode)
        .option("compression", "snappy")
        .partitionBy("date")
        .parquet(path)
    )
    return counted.get["rows"]


def write_table(df: DataFrame, path: str, mode: str = "error") -> None:
    """Features or signals as Snappy Parquet."""
    df.write.mode(mode).option("compression", "snappy").parquet(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A whole Parquet table."""
    return spark.read.parquet(path)


def load_minimal(spark: SparkSession, path: str) -> DataFrame:
    """What the feature stage needs of the clean posts, complete rows only.

    ``source_file`` comes along where there is one: with it a uid names one row.
    """
    posts = read_table(spark, path)
    more = [c for c in ("source_file",) if c in posts.columns]
    return drop_incomplete(posts.select(*MINIMAL_COLUMNS, *more))


def rows_per_file(files: DataFrame, posts: DataFrame) -> DataFrame:
    """``name, rows`` for every discovered file, also for those that gave no rows."""
    counts = posts.groupBy(F.col("source_file").alias("name")).agg(F.count("*").alias("rows"))
    return files.select("name").join(counts, "name", "left").fillna(0, ["rows"])


def run_summary(per_file: DataFrame, parquet_path: str, note: str = "") -> DataFrame:
    """One row: files, rows written, time, place. The names are in the table of files, whatever their number."""
    return per_file.agg(F.count("*").alias("files"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows_written")).withColumns({
        "created_at": F.lit(datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")),
        "parquet_path": F.lit(parquet_path),
        "note": F.lit(note),
    })


def write_json(df: DataFrame, path: str, mode: str = "error") -> None:
    df.write.mode(mode).json(path)


def write_csv_by_hashtag(posts: DataFrame, path: str, mode: str = "error", **options: str) -> None:
    """CSV files with a header, one folder per hashtag; ``options`` are further ones of Spark's writer, such as ``compression``.

    A post stands here once for each of its hashtags, so its rows are large in a shuffle but small in a Parquet table, where
    they stand side by side. They are kept as such a table and dealt out by hashtag slice by slice; a slice, and what it has
    shuffled, goes before the next. A hashtag has a file per slice at least. The last slice marks the folder as complete.
    """
    flat = posts.select(*[
        F.concat_ws(", ", c).alias(c) if kind.startswith("array") else F.col(c)
        for c, kind in posts.dtypes
    ])
    spark = flat.sparkSession
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    if mode == "ignore" and target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target):
        return
    folder = run_folder(spark, "csv-rows")
    try:
        flat.write.option("compression", "zstd").parquet(folder)
        release(spark)
        slices = _slices(spark, folder)
        for i, files in enumerate(slices):
            (
                spark.read.schema(flat.schema).parquet(*files)
                .hint("rebalance", F.col("hashtag"))
                .write.mode("append" if i else mode)
                .option("header", True)
                .option("escape", '"')
                .options(**options)
                .option("mapreduce.fileoutputcommitter.marksuccessfuljobs", str(i == len(slices) - 1).lower())
                .partitionBy("hashtag")
                .csv(path)
            )
            remove(spark, *files)
    finally:
        remove(spark, folder)


def _slices(spark: SparkSession, folder: str) -> list[list[str]]:
    """The files of a table in runs of at least ``SLICE_BYTES``, or of a part of all if that is more."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(folder).select("path", "length").collect()
    least = max(SLICE_BYTES, sum(f["length"] for f in files) / SLICES)
    runs, filled = [[]], 0
    for file in sorted(files, key=lambda f: f["path"]):
        if filled >= least:
            runs.append([])
            filled = 0
        runs[-1].append(file["path"])
        filled += file["length"]
    return runs


def write_stats_by_hashtag(stats: DataFrame, path: str, mode: str = "error") -> None:
    """Summary numbers as JSON, one folder per hashtag; the hashtag is kept in the record too."""
    (
        stats.withColumn("tag", F.col("hashtag"))
        .write.mode(mode)
        .option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
        .partitionBy("tag")
        .json(path)
    )
