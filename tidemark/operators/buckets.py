"""Time buckets of the composite signal, with bootstrap intervals."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators import bootstrap, resampling
from tidemark.session import settle

DAY = 86_400_000_000

# Bucket widths are written as a number and one of these units.
UNIT_MICROS = {
    "s": 1_000_000,
    "min": 60_000_000,
    "t": 60_000_000,
    "h": 3_600_000_000,
    "d": DAY,
}

# A spine is unfolded in two steps so that no row ever holds more steps than this.
_SPINE_CHUNK = 4096


def width_micros(freq: str) -> int:
    """``'2h'``, ``'15min'``, ``'1D'`` as microseconds."""
    found = re.fullmatch(r"\s*(\d*)\s*([A-Za-z]+)\s*", freq)
    unit = UNIT_MICROS.get(found.group(2).lower()) if found else None
    count = int(found.group(1) or 1) if found else 0
    if not unit or count < 1:
        raise ValueError(f"cannot read bucket width {freq!r}")
    return count * unit


def bucket_start(df: DataFrame, freq: str, ts: str = "timestamp") -> Column:
    """Start of the bucket a row falls in.

    Buckets count from midnight of the first day. For widths that divide a day
    that is the same grid as counting from 1970, and no pass over the data is
    needed to find the first day.
    """
    width = width_micros(freq)
    micros = F.unix_micros(F.col(ts))
    if DAY % width == 0:
        return F.timestamp_micros(micros - F.pmod(micros, F.lit(width)))
    first = F.unix_micros(df.agg(F.min(ts).alias("first")).scalar())
    origin = first - F.pmod(first, F.lit(DAY))
    return F.timestamp_micros(micros - F.pmod(micros - origin, F.lit(width)))


def bucket_means(
    features: DataFrame, freq: str = "1h", by: Sequence[str] = (), value: str = "composite_signal"
) -> DataFrame:
    """Mean and count per bucket (and group), observed buckets only."""
    bucketed = features.select(
        bucket_start(features, freq).alias("bucket"), *by, F.col(value).alias("_x")
    )
    return bucketed.groupBy("bucket", *by).agg(
        F.avg("_x").alias("signal"), F.count("_x").alias("n")
    ).withColumnRenamed("bucket", "timestamp")


def fill_gaps(signals: DataFrame, freq: str, by: Sequence[str] = ()) -> DataFrame:
    """Add the empty buckets between the first and last of each group, with n = 0.

    ``signals`` is read twice, so it should be settled when it is costly.
    """
    width = width_micros(freq)
    at = F.unix_micros(F.col("timestamp"))
    ends = signals.groupBy(*by).agg(F.min(at).alias("_lo"), F.max(at).alias("_hi"))
    last = F.floor((F.col("_hi") - F.col("_lo")) / F.lit(width)).cast("bigint")
    chunks = ends.where(F.col("_lo").isNotNull()).select(
        *by, "_lo", last.alias("_last"),
        F.explode(F.sequence(F.lit(0).cast("bigint"), last, F.lit(_SPINE_CHUNK).cast("bigint"))).alias("_from"),
    ).repartition(*by, "_from")
    step = F.explode(F.sequence(
        F.col("_from"), F.least(F.col("_last"), F.col("_from") + F.lit(_SPINE_CHUNK - 1))
    ))
    spine = chunks.select(*by, "_lo", step.alias("_step")).select(
        F.timestamp_micros(F.col("_lo") + F.col("_step") * F.lit(width)).alias("timestamp"), *by
    )
    # Null-safe: a group may be null.
    same = [F.col(f"s.{c}").eqNullSafe(F.col(f"o.{c}")) for c in ("timestamp", *by)]
    measured = [c for c in signals.columns if c not in ("timestamp", *by)]
    return (
        spine.alias("s").join(signals.alias("o"), same, "left")
        .select("s.timestamp", *[f"s.{c}" for c in by], *[f"o.{c}" for c in measured])
        .withColumn("n", F.coalesce("n", F.lit(0).cast("bigint")))
    )


def aggregate_signals(
    features: DataFrame,
    freq: str = "1h",
    by: Sequence[str] = (),
    replicates: int = 200,
    alpha: float = 0.05,
    method: str = "poisson",
    gaps: bool | None = None,
    key: Sequence[str] = ("uid",),
    value: str = "composite_signal",
    block: int = resampling.BLOCK,
) -> DataFrame:
    """``timestamp, [by], signal, n, ci_lo, ci_hi``.

    Empty buckets are filled in for the plain series; with ``by`` only if asked
    for. ``method`` is ``poisson``, ``resample`` (as many draws as a bucket has rows, divided
    over blocks of ``block`` rows) or ``none`` (no intervals).
    """
    gaps = not by if gaps is None else gaps
    if method == "none":
        signals = bucket_means(features, freq, by, value)
    else:
        bucketed = features.select(
            bucket_start(features, freq).alias("timestamp"), *by, *key, F.col(value).alias("_x")
        )
        groups = ["timestamp", *by]
        if method == "poisson":
            signals = bootstrap.poisson_intervals(bucketed, groups, key, replicates, alpha)
        elif method == "resample":
            signals = resampling.resampled_intervals(bucketed, groups, key, replicates, alpha, block)
        else:
            raise ValueError(f"unknown bootstrap method {method!r}")
    return fill_gaps(settle(signals), freq, by) if gaps else signals
