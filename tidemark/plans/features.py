"""Clean posts to features and signals."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import lexicon
from tidemark.operators import features as ops
from tidemark.operators.buckets import aggregate_signals
from tidemark.operators.clean import FILE_ORDER, standardize
from tidemark.operators.dedupe import drop_repeats
from tidemark.operators.svd import fit_svd
from tidemark.session import configure, sized_shuffles, stage, stored_bytes
from tidemark.sources import tables


def row_keys(posts: DataFrame) -> list[str]:
    """Columns that name one post: repeats across files are kept unless dropped globally."""
    return [c for c in ("source_file", "uid") if c in posts.columns]


def clean_scores(raw: DataFrame, scope: str = "file", order_by: Sequence[str] | None = None) -> DataFrame:
    """Complete clean posts with polarity, urgency and engagement.

    Posts are scored, and found complete or not, before repeats are dropped: where only the scores are read,
    no text is sorted or shuffled.
    """
    scored = ops.score_reactions(ops.score_text(standardize(raw)))
    judged = scored.withColumn("_complete", F.col("timestamp").isNotNull() & F.col("content").isNotNull())
    unique = drop_repeats(judged, scope=scope, order_by=order_by)
    return unique.where("_complete").drop("_complete", FILE_ORDER)


def build_features(
    posts: DataFrame,
    weights: Mapping[str, float] = ops.DEFAULT_WEIGHTS,
    components: int = 1,
    max_features: int = 5000,
    keys: Sequence[str] | None = None,
    keep: Sequence[str] = (),
    bull: Sequence[str] = lexicon.BULL_WORDS,
    bear: Sequence[str] = lexicon.BEAR_WORDS,
    urgent: Sequence[str] = lexicon.URGENCY_WORDS,
    **svd_options,
) -> DataFrame:
    """Polarity, urgency, engagement, leading text component and composite per post.

    ``posts`` are read three times (words, word pairs, term counts with the other scores), so they
    should be a table. The scores stand beside the term counts, so nothing is joined and no
    post is shuffled; the z-scores then read only those few numbers. With no weight on ``svd_1`` nothing is fitted.
    """
    keys = list(row_keys(posts) if keys is None else keys)
    scored = ops.score_reactions(ops.score_text(posts, bull, bear, urgent))
    names = [c for c in ops.FEATURE_COLUMNS if c not in ("svd_1", "composite_signal")]
    slim = scored.select(*dict.fromkeys([*names, *keys, *keep]))
    weights = {name: w for name, w in weights.items() if w}
    if any(name.startswith("svd_") for name in weights):
        carry = [c for c in slim.columns if c not in keys]
        slim = fit_svd(scored, keys, "content", components, max_features, carry, **svd_options).carried()
    else:
        slim = slim.withColumn("svd_1", F.lit(0.0))
    signal = ops.composite_signal(stage(slim, "scores"), weights)
    more = [f"svd_{j}" for j in range(2, components + 1) if f"svd_{j}" in signal.columns]
    extra = [c for c in (*keys, *keep) if c not in ops.FEATURE_COLUMNS]
    return signal.select(*ops.FEATURE_COLUMNS, *more, *dict.fromkeys(extra))


def run_features(
    spark: SparkSession, posts_path: str, out_dir: str, freq: str = "1h", **options
) -> tuple[str, str]:
    """Write ``features`` and ``signals`` and return their paths.

    Signals are computed from the written features, so the fit runs once.
    """
    configure(spark)
    base = out_dir.rstrip("/")
    # Snappy Parquet unfolds to a few times its size in a shuffle.
    with sized_shuffles(spark, 3 * stored_bytes(spark, posts_path)):
        posts = tables.load_minimal(spark, posts_path)
        tables.write_table(build_features(posts, **options), f"{base}/features")
        features = spark.read.parquet(f"{base}/features")
        signals = aggregate_signals(features, freq, key=row_keys(features))
        tables.write_table(signals, f"{base}/signals")
    return f"{base}/features", f"{base}/signals"
