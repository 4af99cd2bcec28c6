"""The signal series kept up to date while files arrive."""

from __future__ import annotations

import threading
import time
from collections.abc import Mapping
from dataclasses import dataclass, field, replace
from weakref import WeakSet

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tidemark.operators import features as ops
from tidemark.operators.buckets import DAY, width_micros
from tidemark.operators.clean import drop_incomplete, standardize
from tidemark.operators.moments import as_fit, stored_moments
from tidemark.operators.svd import SvdModel


@dataclass(frozen=True)
class FrozenFit:
    """What a batch run learnt: moments of the scores and, if weighted, the text direction.

    z-scores need the whole corpus, which a stream never has.
    """

    moments: Mapping[str, tuple[float, float]]
    weights: Mapping[str, float] = field(default_factory=lambda: dict(ops.DEFAULT_WEIGHTS))
    svd: SvdModel | None = None


def fit_frozen(features: DataFrame, weights: Mapping[str, float], svd: SvdModel | None = None) -> FrozenFit:
    return FrozenFit(ops.fit_moments(features, list(weights)), dict(weights), svd)


def renewed(fit: FrozenFit, spark: SparkSession, folder: str) -> FrozenFit:
    """The fit with the moments that runs or triggers have stored since (``operators.moments``); no post is read again.

    Columns without stored moments keep those of the fit.
    """
    return replace(fit, moments={**fit.moments, **as_fit(stored_moments(spark, folder))})


def live_scores(
    raw: DataFrame,
    fit: FrozenFit,
    delay: str = "1 hour",
    scope: str = "file",
) -> DataFrame:
    """Cleaned posts with their composite; repeats within the delay are dropped."""
    posts = drop_incomplete(standardize(raw)).withWatermark("timestamp", delay)
    keys = ["uid"] if scope == "global" else ["source_file", "uid"]
    unique = posts.dropDuplicatesWithinWatermark(keys)
    scored = ops.score_reactions(ops.score_text(unique))
    if "svd_1" in fit.weights:
        if fit.svd is None:
            raise ValueError("svd_1 has a weight but no fitted model was given")
        scored = scored.withColumn("svd_1", fit.svd.score_text(F.col("content")))
    return ops.composite_signal(scored, fit.weights, fit.moments)


def live_signals(
    raw: DataFrame,
    fit: FrozenFit,
    freq: str = "1h",
    delay: str = "1 hour",
    scope: str = "file",
) -> DataFrame:
    """Mean and count of the composite per tumbling window."""
    width = width_micros(freq)
    if DAY % width:
        raise ValueError("a live bucket width must divide a day")
    return (
        live_scores(raw, fit, delay, scope)
        .groupBy(F.window("timestamp", f"{width} microseconds").alias("_w"))
        .agg(F.avg("composite_signal").alias("signal"), F.count("composite_signal").alias("n"))
        .select(F.col("_w.start").alias("timestamp"), "signal", "n")
    )


class _LateCounter(StreamingQueryListener):
    """Adds up dropped rows as triggers finish. Spark itself remembers the last few triggers only."""

    guard = threading.Lock()
    dropped: dict[str, int] = {}  # by query, whatever its runs
    newest: dict[str, int] = {}  # the last batch counted, by run
    sessions: WeakSet[SparkSession] = WeakSet()
    written: set[str] = set()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        query, run = str(progress.id), str(progress.runId)
        with self.guard:
            if progress.batchId > self.newest.get(run, -1):  # two listeners may tell the same
                late = sum(int(state.numRowsDroppedByWatermark) for state in progress.stateOperators)
                self.dropped[query] = self.dropped.get(query, 0) + late
                self.newest[run] = progress.batchId

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def _count_late(spark: SparkSession) -> None:
    with _LateCounter.guard:
        if spark in _LateCounter.sessions:
            return
        _LateCounter.sessions.add(spark)
    spark.streams.addListener(_LateCounter())


def write_live(signals: DataFrame, path: str, checkpoint: str, drain: bool = False):
    """Start writing each batch's changed windows below ``path``.

    A batch overwrites its own folder, so a repeated batch leaves no second copy.
    With ``drain`` the query ends when all files present have been read.
    """
    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    writer = signals.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
    if drain:
        writer = writer.trigger(availableNow=True)
    _count_late(signals.sparkSession)
    query = writer.foreachBatch(write).start()
    _LateCounter.written.add(query.id)
    return query


def late_rows(query: StreamingQuery, wait: float = 60) -> int:
    """Rows that a stream of ``write_live`` has left out because they came later than its delay allows.

    All triggers of this driver process count, also of earlier runs of the query. Counts arrive shortly after a trigger
    ends; one not here within ``wait`` seconds is an error. Anything but 0 means that the series lacks posts: choose a longer delay.
    """
    if query.id not in _LateCounter.written:
        raise ValueError("late rows are counted for queries that write_live started")
    last, until = query.lastProgress, time.monotonic() + wait
    while last is not None and _LateCounter.newest.get(query.runId, -1) < last.batchId:
        if time.monotonic() > until:
            raise TimeoutError(f"late rows of batch {last.batchId} have not been reported")
        time.sleep(0.05)
    with _LateCounter.guard:
        return _LateCounter.dropped.get(query.id, 0)


def compact(spark: SparkSession, path: str) -> None:
    """Gather the newest state of all windows in the folder of the last batch and remove the older folders.

    For use while no stream writes there. The state is written beside the folders first, so an interrupted
    run leaves either the old folders or, besides the new one, some that repeat what it holds.
    """
    files = spark._jvm.org.apache.hadoop.fs
    root = files.Path(path)
    store = root.getFileSystem(spark._jsc.hadoopConfiguration())
    folders = sorted(
        (int(f.getPath().getName()[6:]), f.getPath()) for f in store.listStatus(root) if f.getPath().getName().startswith("batch=")
    )
    if len(folders) < 2:
        return
    draft = files.Path(f"{path}/_gathered")
    latest_signals(spark, path).write.mode("overwrite").parquet(draft.toString())
    for _, folder in folders:
        store.delete(folder, True)
    store.rename(draft, folders[-1][1])


def latest_signals(spark: SparkSession, path: str) -> DataFrame:
    """The newest state of every window written so far."""
    log = spark.read.parquet(path)
    newest = Window.partitionBy("timestamp").orderBy(F.desc("batch"))
    return log.withColumn("_rank", F.row_number().over(newest)).where("_rank = 1").drop("_rank", "batch")
