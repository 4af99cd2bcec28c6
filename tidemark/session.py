"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"

# Runtime settings the operators rely on: times are UTC, AQE splits skewed join sides
# and sizes shuffle partitions from what was really written, Arrow batches of long
# texts are bounded by bytes as well as rows, and stream state lives outside the heap.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(16 * 1024 * 1024),
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}

_local_folders: dict[str, str] = {}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session made elsewhere."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: str = "*", shuffle_partitions: int = 8, memory: str = "16g") -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tidemark")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    spark = configure(builder.getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


INITIAL_PARTITIONS_KEY = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
PARTITION_BYTES = 128 * 1024 * 1024
MAX_PARTITIONS = 500_000
TASK_ROWS = 1 << 16


@contextmanager
def sized_shuffles(spark: SparkSession, input_bytes: int) -> Iterator[int]:
    """Start shuffles with about one partition per 128 MB of input.

    The fixed default would give a 100 TB shuffle a few huge partitions; AQE joins
    those that turn out small. The setting is put back afterwards.
    """
    usual = int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = min(max(usual, input_bytes // PARTITION_BYTES), MAX_PARTITIONS)
    before = spark.conf.get(INITIAL_PARTITIONS_KEY, None)
    spark.conf.set(INITIAL_PARTITIONS_KEY, str(wanted))
    try:
        yield wanted
    finally:
        if before is None:
            spark.conf.unset(INITIAL_PARTITIONS_KEY)
        else:
            spark.conf.set(INITIAL_PARTITIONS_KEY, before)


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Size of all files below a path, from the listing alone."""
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return listing.selectExpr("sum(length) as bytes").first()["bytes"] or 0


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by the cluster.

    Only a local session may fall back to a temporary folder: on a cluster a
    machine-local folder would be lost with its executor.
    """
    folder = spark.conf.get(CHECKPOINT_KEY, None)
    context = spark.sparkContext
    if folder is None:
        folder = _local_folders.get(context.applicationId)
    if folder is None:
        if not context.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix="tidemark-")
        _local_folders[context.applicationId] = folder
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def run_folder(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; nothing exists there yet."""
    return f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def spread(scan: DataFrame, stored: int = 0) -> DataFrame:
    """Deal out a file scan of ``stored`` bytes that has too few splits for heavy work per row.

    Files may be badly split, and a small file may hold many rows: a task gets at most about ``TASK_ROWS`` rows
    or ``PARTITION_BYTES`` stored bytes, so its time doesn't grow with the table, and every core has one. Scans with
    enough splits pass through untouched. Meant for plain scans, where counting rows reads no column.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    wanted = max(cores, -(-scan.count() // TASK_ROWS), -(-stored // PARTITION_BYTES))
    return scan.repartition(min(wanted, MAX_PARTITIONS)) if scan.rdd.getNumPartitions() < wanted else scan


def settle(df: DataFrame) -> DataFrame:
    """Compute a small result once and cut its lineage with a reliable checkpoint."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def stage(df: DataFrame, label: str, **options: str) -> DataFrame:
    """Compute a large result once as a Parquet table in the shared folder.

    Later passes read only the columns they need. ``options`` are those of the writer.
    """
    spark = df.sparkSession
    path = run_folder(spark, label)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, *places: str) -> None:
    """Take away folders of ``run_folder``, or files in them, that nothing reads any more, and the shuffles behind them."""
    for place in places:
        path = spark._jvm.org.apache.hadoop.fs.Path(place)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    release(spark)


def release(spark: SparkSession) -> None:
    """Have the files of shuffles removed that belong to finished work: Spark keeps them until the driver collects its garbage."""
    gc.collect()
    spark._jvm.System.gc()
