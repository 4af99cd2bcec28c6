"""From raw posts to clean posts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import text, values
from tidemark.operators.dedupe import drop_repeats

# The column contract of raw and clean posts.
EXPECTED_COLUMNS = (
    "username", "timestamp", "content",
    "replies", "retweets", "likes",
    "mentions", "hashtags", "urls",
    "scraped_at",
)
CORE_COLUMNS = (
    "uid", "username", "timestamp", "content",
    "replies", "retweets", "likes",
    "_mentions_list", "_hashtags_list", "urls",
    "scraped_at", "hashtag_primary", "date",
)

# Position of a row in its file, set by the readers and gone after cleaning.
FILE_ORDER = "_file_order"


def with_expected_columns(raw: DataFrame) -> DataFrame:
    """Add the expected columns that are missing, as nulls, and ``source_file``."""
    missing = {c: F.lit(None).cast("string") for c in EXPECTED_COLUMNS if c not in raw.columns}
    if "source_file" not in raw.columns:
        missing["source_file"] = F.lit("")
    return raw.withColumns(missing) if missing else raw


def standardize(raw: DataFrame, strip_brackets: bool = False, marks: bool = False) -> DataFrame:
    """Normalise every column of raw posts; one row in, one row out.

    Core columns come first, then whatever else the input had, then
    ``source_file``.
    """
    full = with_expected_columns(raw)
    kinds = {field.name: field.dataType for field in full.schema.fields}
    kept = [
        c for c in full.columns
        if c not in CORE_COLUMNS and c not in ("source_file", FILE_ORDER)
    ]
    order = [FILE_ORDER] if FILE_ORDER in full.columns else []

    def listed(name: str):
        return text.parse_listish(F.col(name), kinds[name], strip_brackets)

    plain = full.select(
        text.normalize_text(F.col("username")).alias("username"),
        text.normalize_text(F.col("content")).alias("content"),
        text.normalize_text(F.col("urls")).alias("urls"),
        *[values.coerce_int(F.col(c), kinds[c]).alias(c) for c in ("replies", "retweets", "likes")],
        *[values.to_utc(F.col(c), kinds[c]).alias(c) for c in ("timestamp", "scraped_at")],
        listed("mentions").alias("_given_mentions"),
        listed("hashtags").alias("_given_hashtags"),
        *[_plain_text(c, kinds[c]) for c in kept],
        "source_file",
        *order,
    )
    tagged = plain.withColumns({
        "_mentions_list": text.extract_mentions(F.col("content"), F.col("_given_mentions"), marks),
        "_hashtags_list": text.extract_hashtags(F.col("content"), F.col("_given_hashtags"), marks),
        "uid": values.stable_uid(F.col("username"), F.col("timestamp"), F.col("content")),
        "date": values.calendar_date(F.col("timestamp")),
    })
    return tagged.withColumn(
        "hashtag_primary", values.first_item(F.col("_hashtags_list"))
    ).select(*CORE_COLUMNS, *kept, "source_file", *order)


def _plain_text(name: str, kind: T.DataType):
    """Variants are written as text: not every Parquet reader knows them."""
    return F.col(name).cast("string").alias(name) if isinstance(kind, T.VariantType) else F.col(name)


def clean_posts(
    raw: DataFrame,
    scope: str = "file",
    order_by: Sequence[str] | None = None,
    strip_brackets: bool = False,
    marks: bool = False,
    columns: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Standardised posts without repeats. One shuffle, on the identity of a post.

    ``columns`` are what is wanted of the posts, by name. They are computed before that shuffle, so no text travels of which only a
    digest or a length is read.
    """
    clean = standardize(raw, strip_brackets, marks)
    wanted = {f"_wanted_{name}": column for name, column in (columns or {}).items()}
    unique = drop_repeats(clean.withColumns(wanted) if wanted else clean, scope=scope, order_by=order_by)
    if columns is None:
        return unique.drop(FILE_ORDER)
    return unique.select(*[F.col(f"`_wanted_{name}`").alias(name) for name in columns])


def drop_incomplete(posts: DataFrame) -> DataFrame:
    """Rows must have a time and a text; empty text is a text."""
    return posts.dropna(subset=["timestamp", "content"])


def complete_records(posts: DataFrame) -> DataFrame:
    """Rows must name an author and say something."""
    return posts.where((F.col("username") != "") & (F.col("content") != ""))


def external_urls(urls, excluded_host: str = "twitter.com"):
    """Absolute links that do not lead back to the excluded host."""
    return F.filter(
        urls, lambda url: url.rlike("^https?://") & ~url.contains(excluded_host)
    )
