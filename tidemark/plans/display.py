"""Signals to a series short enough to draw."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemark.operators.series import downsample, for_hashtag, sort_by_time


def display_series(signals: DataFrame, hashtag: str | None = None, target: int = 1500) -> DataFrame:
    """``timestamp, signal, ci_lo, ci_hi`` in time order, at most ``target`` rows."""
    series = for_hashtag(signals, hashtag).select("timestamp", "signal", "ci_lo", "ci_hi")
    return sort_by_time(downsample(series, target, order_by=("timestamp", "signal")))
