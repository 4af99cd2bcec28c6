"""Keep-first operators.

All are ``row_number() <= n`` over a window, which Spark cuts to n rows per group
in every map task *before* the shuffle (WindowGroupLimit). A group of copies that
holds a third of the table therefore reaches its reducer as n rows per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import values


def first_rows(df: DataFrame, keys: Sequence[str], order_by: Sequence, n: int = 1) -> DataFrame:
    """The first n rows of every group."""
    window = Window.partitionBy(*keys).orderBy(*order_by)
    return df.withColumn("_rank", F.row_number().over(window)).where(f"_rank <= {int(n)}").drop("_rank")


def drop_repeats(
    posts: DataFrame, scope: str = "file", order_by: Sequence[str] | None = None
) -> DataFrame:
    """First row of each ``uid``, within one source file or over all of them.

    Without ``order_by`` the order is the order of rows in their file.
    """
    if scope not in ("file", "global"):
        raise ValueError(f"scope must be 'file' or 'global', not {scope!r}")
    if order_by is None:
        placed = "_file_order" in posts.columns
        order_by = ["source_file", "_file_order"] if placed else ["source_file", "scraped_at", "likes"]
    return first_rows(posts, ["source_file", "uid"] if scope == "file" else ["uid"], order_by)


def drop_same_content(
    posts: DataFrame, order_by: Sequence[str], group: Sequence[str] = ("hashtag",)
) -> DataFrame:
    """First row of each author and text within a group, whatever its time."""
    keyed = posts.withColumn("_key", values.content_key(F.col("username"), F.col("content")))
    return first_rows(keyed, [*group, "_key"], order_by).drop("_key")


def cap_per_group(
    posts: DataFrame,
    limit: int = 500,
    order_by: Sequence[str] = ("timestamp", "uid"),
    group: Sequence[str] = ("hashtag",),
    slices: int = 64,
) -> DataFrame:
    """At most ``limit`` rows per group, the first in order.

    The first cut runs in slices of each group, so the last one sees no more than
    slices x limit rows of a group however large the group is.
    """
    sliced = posts.withColumn("_slice", F.pmod(F.xxhash64(*order_by), F.lit(slices)))
    narrowed = first_rows(sliced, [*group, "_slice"], order_by, limit)
    return first_rows(narrowed, group, order_by, limit).drop("_slice")
