"""Helpers of the corpus operators: word pattern, files in the shared folder, batches."""

from __future__ import annotations

import ctypes
import gc
import uuid
from contextlib import suppress

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession

from tidemark.session import MAX_PARTITIONS, PARTITION_BYTES, configure, run_folder, stage

# What separates words.
WORD_GAP = r"[\x20\x09-\x0D]+"
GAP_BYTES = b" \t\n\x0b\x0c\r"


# Batches between Spark and Python hold whole texts; two workers share an executor's rest of memory.
BATCH_SETTINGS = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(4 * 1024 * 1024),
}


def prepare(spark: SparkSession) -> SparkSession:
    """Settings of the library, with smaller batches for texts."""
    configure(spark)
    for key, value in BATCH_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def input_bytes(df: DataFrame) -> int:
    """Stored bytes of the tables a frame reads, as its plan knows them; tables of unknown size count as nothing."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size())]
    return sum(size for size in sizes if size < 1 << 60)


def parts_for(df: DataFrame) -> int:
    """Partitions for an explicit shuffle of a frame, which AQE doesn't cut: as configured, more for large inputs."""
    usual = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return min(max(usual, input_bytes(df) // PARTITION_BYTES), MAX_PARTITIONS)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_uri(spark: SparkSession, label: str) -> str:
    """A fresh folder below the shared one, as a URI that tasks can open with pyarrow."""
    folder = run_folder(spark, label)
    return folder if "://" in folder else f"file://{folder}"


def open_store(uri: str) -> tuple[pa.fs.FileSystem, str]:
    return pa.fs.FileSystem.from_uri(uri)


def write_once(folder: str, stem: str):
    """Open a new file below ``folder``; each task attempt gets a name of its own.

    Only names that a finished task reports are ever read, so what a lost
    attempt leaves behind does no harm.
    """
    store, root = open_store(folder)
    store.create_dir(root, recursive=True)
    name = f"{stem}-{uuid.uuid4().hex}"
    return store.open_output_stream(f"{root}/{name}"), f"{folder}/{name}"


def texts_of(column: pa.Array) -> list[str]:
    """Values of a string column; null counts as empty."""
    return [value or "" for value in column.to_pylist()]


def bytes_of(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; null counts as empty."""
    return [value or b"" for value in column.cast(pa.binary()).to_pylist()]


class Scratch:
    """Tables that only one computation reads, in a folder of its own below the shared one.

    ``result`` writes what it comes to and removes the folder, so nothing that is read later depends on it. Shuffles
    behind written tables are given back too: Spark keeps their files until the driver collects its garbage.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.label, self.folder, self.tables = spark, label, run_folder(spark, f"{label}-scratch"), 0

    def stage(self, df: DataFrame, name: str) -> DataFrame:
        self.tables += 1
        path = f"{self.folder}/{name}-{self.tables}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def release(self) -> None:
        gc.collect()
        self.spark._jvm.System.gc()

    def result(self, df: DataFrame) -> DataFrame:
        written = stage(df, self.label)
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)
        self.release()
        return written


def trim() -> None:
    """Hand back what a worker has freed: it lives on for tasks of other kinds, beside others of its executor."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):  # a C library without this call
        ctypes.CDLL(None).malloc_trim(0)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
