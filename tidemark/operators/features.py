"""Per-post scores, z-scores and their weighted blend."""

from __future__ import annotations

import sys
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import lexicon

# How much each z-scored part counts in the composite.
DEFAULT_WEIGHTS = {"polarity": 0.4, "engagement": 0.3, "svd_1": 0.3}

FEATURE_COLUMNS = (
    "uid", "timestamp", "username", "hashtag_primary", "_hashtags_list",
    "polarity", "urgency", "engagement", "svd_1", "composite_signal",
)


def score_text(
    posts: DataFrame,
    bull: Iterable[str] = lexicon.BULL_WORDS,
    bear: Iterable[str] = lexicon.BEAR_WORDS,
    urgent: Iterable[str] = lexicon.URGENCY_WORDS,
) -> DataFrame:
    """Add ``polarity`` and ``urgency``.

    The words are split once and cut once to those in any list; the lists are
    then counted on that short rest.
    """
    bull, bear, urgent = set(bull), set(bear), set(urgent)
    words, hits = F.col("_words"), F.col("_hits")
    return (
        posts.withColumn("_words", lexicon.words_of(F.col("content")))
        .withColumn("_hits", lexicon.matches(words, bull | bear | urgent))
        .withColumns({
            "polarity": lexicon.share(
                F.size(lexicon.matches(hits, bull)) - F.size(lexicon.matches(hits, bear)), words
            ),
            "urgency": lexicon.share(F.size(lexicon.matches(hits, urgent)), words),
        })
        .drop("_words", "_hits")
    )


def score_reactions(posts: DataFrame) -> DataFrame:
    """Add ``engagement``."""
    return posts.withColumn(
        "engagement",
        lexicon.engagement(F.col("likes"), F.col("retweets"), F.col("replies")),
    )


def _moments(column: str) -> Column:
    """Mean and deviation; a deviation within the rounding error of the sum is 0."""
    mean, spread = F.avg(column), F.stddev_pop(column)
    noise = F.count(column) * F.lit(sys.float_info.epsilon) * F.abs(mean)
    return F.struct(
        mean.alias("mean"), F.when(spread > noise, spread).otherwise(F.lit(0.0)).alias("spread")
    ).alias(column)


def fit_moments(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population deviation per column, as plain numbers (one row comes back)."""
    row = df.agg(*[_moments(c) for c in columns]).first()
    return {c: (row[c]["mean"], row[c]["spread"]) for c in columns}


def standard_scores(
    df: DataFrame,
    columns: Sequence[str],
    moments: Mapping[str, tuple[float, float]] | None = None,
) -> dict[str, Column]:
    """Column expressions for global z-scores; a constant column scores 0.

    Without given moments they come from a scalar subquery: Spark computes one
    row by partial aggregation and hands it to every task. There is no shuffle of
    the data and no window over the whole table.
    """
    if moments is not None:
        pairs = {c: (F.lit(moments[c][0]), F.lit(moments[c][1])) for c in columns}
    else:
        stats = df.agg(F.struct(*[_moments(c) for c in columns]).alias("moments")).scalar()
        pairs = {c: (stats[c]["mean"], stats[c]["spread"]) for c in columns}
    return {
        c: (F.col(c) - mean) / F.when(spread == 0, F.lit(1.0)).otherwise(spread)
        for c, (mean, spread) in pairs.items()
    }


def zscore(
    df: DataFrame,
    columns: Sequence[str],
    moments: Mapping[str, tuple[float, float]] | None = None,
    suffix: str = "_z",
) -> DataFrame:
    """Add the z-score of each column."""
    scores = standard_scores(df, columns, moments)
    return df.withColumns({f"{c}{suffix}": score for c, score in scores.items()})


def composite_signal(
    df: DataFrame,
    weights: Mapping[str, float] = DEFAULT_WEIGHTS,
    moments: Mapping[str, tuple[float, float]] | None = None,
) -> DataFrame:
    """Add ``composite_signal``, the weighted sum of z-scores."""
    scores = standard_scores(df, list(weights), moments)
    blend = None
    for name, weight in weights.items():
        part = F.lit(float(weight)) * scores[name]
        blend = part if blend is None else blend + part
    return df.withColumn("composite_signal", blend)
