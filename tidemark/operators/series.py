"""Preparing a signal series for display."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import settle

# monotonically_increasing_id keeps the row number inside a partition in its low bits.
_LOCAL_BITS = 33

# More wanted places than this are joined by a shuffle.
_BROADCAST_ROWS = 1_000_000


def for_hashtag(signals: DataFrame, hashtag: str | None) -> DataFrame:
    """One hashtag's series, or everything."""
    return signals.where(F.col("hashtag_primary") == hashtag) if hashtag else signals


def sort_by_time(df: DataFrame, then: Sequence[str] = ()) -> DataFrame:
    """Order by time; further columns keep one busy instant from being one task."""
    return df.orderBy("timestamp", *then)


def numbered(df: DataFrame, order_by: Sequence[str]) -> DataFrame:
    """The order keys of all rows, with ``_index``, a row's place in sorted order from 0.

    Only the keys are range-partitioned, sorted and kept. Each partition
    counts its own rows; the running totals (one row per partition) are added to
    the local places. No task sees more than its partition.
    """
    placed = settle(
        df.select(*order_by).orderBy(*order_by).withColumn("_place", F.monotonically_increasing_id())
    )
    part = F.shiftright("_place", _LOCAL_BITS)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("n")).collect()
    starts, total = [], 0
    for row in sorted(sizes, key=lambda r: r["_part"]):
        starts.append((row["_part"], total))
        total += row["n"]
    offsets = df.sparkSession.createDataFrame(starts, "_part bigint, _start bigint")
    local = F.col("_place").bitwiseAND((1 << _LOCAL_BITS) - 1)
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn("_index", F.col("_start") + local)
        .drop("_place", "_part", "_start")
    )


def downsample(
    df: DataFrame, target: int = 1000, order_by: Sequence[str] = ("timestamp",)
) -> DataFrame:
    """At most ``target`` rows at even distances, first and last included.

    The rows are computed once and counted; then only their order keys are numbered, and the rows
    at the wanted keys are fetched. Computed anew, a mean may differ in its last bit and its key would not be found. Of rows with equal keys as many come as places are wanted there.
    """
    if target < 2:
        raise ValueError("target must be at least 2")
    df = settle(df)
    total = df.count()
    if total <= target:
        return df
    step = F.lit((total - 1) / (target - 1))
    wanted = df.sparkSession.range(target).select(
        F.when(F.col("id") == target - 1, F.lit(total - 1))
        .otherwise(F.floor(F.col("id").cast("double") * step))
        .cast("bigint").alias("_index")
    )
    few = target <= _BROADCAST_ROWS  # a size check: the result is the same either way
    wanted = numbered(df, order_by).join(F.broadcast(wanted) if few else wanted, "_index")
    names = [f"_key{i}" for i in range(len(order_by))]
    wanted = wanted.groupBy(*[F.col(c).alias(n) for c, n in zip(order_by, names, strict=True)]).agg(F.count("*").alias("_times"))
    same = [df[c].eqNullSafe(wanted[n]) for c, n in zip(order_by, names, strict=True)]
    found = df.join(F.broadcast(wanted) if few else wanted, same)
    # the fixed bound lets each task keep no more of one key than could be wanted
    among = Window.partitionBy(*names).orderBy(F.xxhash64(*[df[c] for c in df.columns]))
    ranked = found.withColumn("_among", F.row_number().over(among)).where(F.col("_among") <= target)
    return ranked.where("_among <= _times").select(*[df[c] for c in df.columns])
