"""Summary numbers per hashtag."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def summarize_by_hashtag(
    posts: DataFrame, group: Sequence[str] = ("hashtag",), approximate_users: bool = False
) -> DataFrame:
    """Posts, distinct authors, mean reactions and date range per hashtag.

    Distinct authors are first reduced to one row per (hashtag, author), so a
    hashtag with most of the posts is still counted by many tasks.
    """
    users = F.approx_count_distinct("username") if approximate_users else F.count_distinct("username")
    return posts.groupBy(*group).agg(
        F.count("*").alias("total_tweets"),
        users.alias("unique_users"),
        F.avg("likes").alias("avg_likes"),
        F.avg("retweets").alias("avg_retweets"),
        F.avg("replies").alias("avg_replies"),
        F.struct(F.min("timestamp").alias("start"), F.max("timestamp").alias("end")).alias("date_range"),
    )


def explode_hashtags(posts: DataFrame, into: str = "hashtag") -> DataFrame:
    """One row per post and hashtag, the tag without its ``#``."""
    return posts.withColumn(into, F.explode("_hashtags_list")).withColumn(
        into, F.regexp_replace(into, "^#", "")
    )


def user_sketches(posts: DataFrame, group: Sequence[str] = ("hashtag", "date"), bits: int = 14) -> DataFrame:
    """Per group the posts and a sketch of their authors, to be stored and united over any range later.

    A sketch takes up to 2 ** bits bytes or so however many authors it has seen, and is built by every map task. The
    relative standard error of a count is about 0.83 / 2 ** (bits / 2), 0.65 % by default. Null authors are not counted.
    """
    return posts.groupBy(*group).agg(F.count("*").alias("posts"), F.hll_sketch_agg("username", F.lit(bits)).alias("users"))


def united_users(sketches: DataFrame, group: Sequence[str] = ("hashtag",)) -> DataFrame:
    """``posts, users, unique_users`` per coarser group: sketches united, so authors of several parts count once.

    The rows can be united again; ``unique_users`` is the estimate, exact or nearly so for small groups.
    """
    united = sketches.groupBy(*group).agg(F.sum("posts").alias("posts"), F.hll_union_agg("users").alias("users"))
    return united.withColumn("unique_users", F.hll_sketch_estimate("users"))
