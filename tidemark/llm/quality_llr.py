"""Quality rules and a hashed n-gram log-likelihood ratio, in DataFrame functions only.

Words and neighbouring word pairs are hashed into a fixed number of buckets. Two multinomials over the
buckets are counted, one over trusted documents and one over the whole corpus, both smoothed by one
per bucket. A document's score is the mean log ratio of its n-grams; it is kept from a fixed threshold on.
Ratios are rounded to millionths, so sums are whole numbers and every run decides alike.

Counting and scoring each read the texts once; only bucket counts are shuffled, combined per task first. The
ratios are one array of ``buckets`` numbers, whatever the corpus.

The verdict is on quality. It is no filter for toxic text: a few toxic words hardly move a mean over a whole text,
so nearly all toxic documents of good quality are kept, though none is trusted. Take them out by a label or model of their own.

Defined results: a null or empty text, and one of gaps only, has no words and fails the base rules. Without trusted
rows all ratios are 0. Rows are judged one by one, so repeated rows get equal verdicts; other columns
of the input, whatever their names, are neither read nor returned. A null text never counts in the corpus.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 1 << 14
SCALE = 1_000_000
# Multiplier that joins the hashes of two words, symbols that count as noise.
PAIR = 1_000_003
SYMBOLS = "[#*$%&|<>]"
GAP_CHARS = " \t\n\x0b\x0c\r"


def words(text: Column) -> Column:
    """Runs of anything but gaps; splitting at single spaces takes no pattern matching."""
    spaced = F.coalesce(text, F.lit(""))
    for gap in GAP_CHARS[1:]:
        spaced = F.replace(spaced, F.lit(gap), F.lit(" "))
    return F.array_remove(F.split(spaced, " "), "")


def word_codes(found: Column) -> Column:
    return F.transform(found, lambda w: F.crc32(w.cast("binary")))


def pair_codes(codes: Column) -> Column:
    """One number for each two neighbours."""
    n_pairs = F.greatest(F.size(codes) - 1, F.lit(0))
    return F.zip_with(
        F.slice(codes, F.lit(1), n_pairs), F.slice(codes, F.lit(2), n_pairs), lambda a, b: a * PAIR + b
    )


def bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once per row, also where lambdas refer to it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def repeat_words(found: Column, pairs: Column) -> Column:
    """Words in 3-word windows that occur twice or more.

    Two pair codes give a window's hash. Texts with repeated hashes, a small part, sort the windows
    with their places, so that equal ones become neighbours.
    """
    n_windows = F.greatest(F.size(pairs) - 1, F.lit(0))
    hashes = F.zip_with(
        F.slice(pairs, F.lit(1), n_windows), F.slice(pairs, F.lit(2), n_windows),
        lambda a, b: F.shiftleft(a, 11).bitwiseXOR(b),
    )

    def covered(ordered: Column) -> Column:
        def same(k: Column, other: Column) -> Column:
            return F.coalesce(F.get(ordered, k)["g"] == F.get(ordered, other)["g"], F.lit(False))

        repeated = F.filter(
            F.sequence(F.lit(0), F.size(ordered) - 1), lambda k: same(k, k - 1) | same(k, k + 1)
        )
        places = F.transform(repeated, lambda k: F.get(ordered, k)["i"])
        return F.size(F.array_distinct(F.flatten(F.transform(places, lambda p: F.array(p, p + 1, p + 2)))))

    windows = F.transform(
        F.sequence(F.lit(0), F.size(found) - 3),
        lambda i: F.struct(
            F.concat_ws(" ", F.get(found, i), F.get(found, i + 1), F.get(found, i + 2)).alias("g"), i.alias("i")
        ),
    )
    distinct = bound(hashes, lambda h: F.size(F.array_distinct(h)) == F.size(h))
    return F.when(distinct, F.lit(0)).otherwise(bound(F.sort_array(windows), covered)).cast("long")


def base_columns(text: Column, found: Column, pairs: Column) -> dict[str, Column]:
    """The rule figures of a text, given its words and their pair codes."""
    text = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(GAP_CHARS)) != "")
    return {
        "n_words": F.size(found).cast("long"),
        "word_chars": F.length(F.array_join(found, "")).cast("long"),
        "n_symbols": F.regexp_count(text, F.lit(SYMBOLS)).cast("long"),
        "n_dup_lines": bound(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
        "n_repeat_words": repeat_words(found, pairs),
    }


def fit_ratios(
    docs: DataFrame, trusted: DataFrame, key: str = "doc_id", text: str = "text",
    buckets: int = BUCKETS, trusted_rows: int = 50_000,
) -> list[int]:
    """Log ratio of every bucket in millionths.

    ``trusted`` lists keys of good documents. ``trusted_rows`` bounds how many are learned from, those
    with the smallest hashes; so that list can be broadcast. Corpus counts take every document.
    """
    sample = (
        trusted.select(F.col(key).alias("_key")).where("_key is not null").distinct()
        .orderBy(F.md5(F.col("_key").cast("string")), "_key").limit(trusted_rows)
        .withColumn("_good", F.lit(1))
    )
    codes = (
        docs.select(F.col(key).alias("_key"), word_codes(words(F.col(text))).alias("_codes"))
        .join(F.broadcast(sample), "_key", "left")
        .select("_good", F.explode(F.concat("_codes", pair_codes(F.col("_codes")))).alias("_code"))
    )
    counts = codes.groupBy((F.col("_code") % buckets).alias("_bucket")).agg(
        F.count("*").alias("raw"), F.count("_good").alias("good")
    )
    raw, good = [0] * buckets, [0] * buckets
    for row in counts.collect():  # one row per bucket at most
        raw[row["_bucket"]], good[row["_bucket"]] = row["raw"], row["good"]
    if not any(good):
        return [0] * buckets
    shift = math.log(sum(raw) + buckets) - math.log(sum(good) + buckets)
    return [
        math.floor(SCALE * (math.log(g + 1) - math.log(r + 1) + shift) + 0.5)
        for g, r in zip(good, raw, strict=True)
    ]


def judge(
    docs: DataFrame, ratios: list[int], key: str = "doc_id", text: str = "text",
    threshold: int = -55_000,
) -> DataFrame:
    """One row per document: base figures, mean log ratio in millionths, verdicts.

    ``threshold`` is the least mean log ratio of a kept document, in millionths.
    """
    # folded into one constant array before the job starts
    table = F.from_json(F.lit(str(ratios)), "array<bigint>")
    figures = (
        docs.select(F.col(key), F.col(text).alias("_text"), words(F.col(text)).alias("_words"))
        .withColumn("_codes", word_codes(F.col("_words")))
        .withColumn("_pairs", pair_codes(F.col("_codes")))
    )

    def summed(codes: str) -> Column:
        return F.aggregate(
            codes, F.lit(0).cast("long"), lambda acc, c: acc + F.get(table, (c % len(ratios)).cast("int"))
        )

    columns = base_columns(F.col("_text"), F.col("_words"), F.col("_pairs"))
    figures = figures.select(
        F.col(key), *[c.alias(name) for name, c in columns.items()],
        (summed("_codes") + summed("_pairs")).alias("llr_sum"),
    )
    n_grams = F.greatest(2 * F.col("n_words") - 1, F.lit(0))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return figures.withColumn("base_failed", failed).withColumn(
        "kept", ~F.col("base_failed") & (F.col("llr_sum") >= threshold * n_grams)
    )
