"""How filters of documents act on each other, for every order in which they can be applied.

Most filters judge a document by itself. One, on copies, needs the table: a left-semi join on hash, exact text and a smaller id
marks the documents that repeat an earlier one. Its ids are put under those that fail the other filters, as rows of (id, failure);
one aggregation joins them to a combination of failures per document, a second counts documents per part and combination.
Whatever an order of filters does follows from these few counts: a document goes at its first failing filter, no text is read again.

The join meets each document with one row per repeated text, the one with the least id, not with its copies. Texts that
very many documents share are salted: of hashes with more than 1/HOT of all rows there are HOT at most, so a broadcast
tells them, and their representative is there once for each salt.

Defined results: a null or empty text has no words and characters, and both are the same text. Null ids are no smaller ids, and such a row is
never a copy. Rows with equal id and text are no copies of each other. A null part is the empty string. Labels of one id count
as one, good or toxic if any row says so. An empty table has no parts and so no rows. Other columns aren't read.
"""

from __future__ import annotations

from collections.abc import Mapping
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.quality_llr import bound, words
from tidemark.session import stage

HOT = 100_000
LEAST_GROUP = 256
# The rules of the audit.
LEAST_WORDS = 200
SIGNS = r"[#$%&*|]"


def default_filters(text: Column) -> dict[str, Column]:
    """Failure conditions that need the text alone: short, repetitive, many capitals, signs."""
    capitals = F.regexp_count(text, F.lit("[A-Z]"))
    counted = bound(words(text), lambda w: F.struct(F.size(w).alias("n"), F.size(F.array_distinct(w)).alias("kinds")))
    return {
        "A": counted["n"] < LEAST_WORDS, "B": 100 * counted["kinds"] < 50 * counted["n"],
        "C": 100 * capitals > 3 * F.length(text), "D": text.rlike(SIGNS),
    }


def copies(rows: DataFrame) -> DataFrame:
    """Those of (id, tag, text, ...) whose text a row with a smaller id has too. ``tag`` is a hash of the text."""
    rows = rows.where("id is not null")
    total = rows.count()
    repeated = rows.groupBy("tag", "text").agg(
        F.min("id").alias("least"), F.max("id").alias("most"), F.count("*").alias("n")
    ).where("least < most")
    earlier = stage(repeated.select("tag", "text", "least", "n"), "earlier")
    share = max(LEAST_GROUP, total // HOT)
    hot = earlier.groupBy("tag").agg(F.sum("n").alias("n")).where(F.col("n") > share)
    hot = F.broadcast(hot.select("tag", F.ceil(F.col("n") / share).cast("int").alias("salts")))  # HOT rows at most
    salts = F.coalesce("salts", F.lit(1))
    salted = rows.join(hot, "tag", "left").withColumn("salt", F.pmod(F.monotonically_increasing_id(), salts).cast("int"))
    earlier = earlier.join(hot, "tag", "left").select(
        F.col("tag").alias("e_tag"), F.col("text").alias("e_text"), "least", F.explode(F.sequence(F.lit(0), salts - 1)).alias("e_salt")
    )
    same = (F.col("tag") == F.col("e_tag")) & (F.col("salt") == F.col("e_salt")) & (F.col("text") == F.col("e_text"))
    return salted.join(earlier, same & (F.col("least") < F.col("id")), "left_semi").drop("salt", "salts")


def combinations(
    docs: DataFrame, labels: DataFrame, filters: Mapping[str, Column] | None = None, copy_filter: str = "E",
    key: str = "doc_id", text: str = "text", part: str = "lang",
) -> DataFrame:
    """(part, fails, n, good, toxic): documents per combination of failing filters, written as their letters in order.

    ``filters`` are conditions over the columns ``text``, ``id`` and ``part``, by one letter each.
    """
    filters = dict(default_filters(F.col("text")) if filters is None else filters)
    letters = [*filters, copy_filter]
    content = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(key).cast("long").alias("id"), F.xxhash64(content).alias("tag"),
        F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), content.alias("text"),
    )
    bits = [F.when(failed, F.lit(1 << k)).otherwise(F.lit(0)) for k, failed in enumerate(filters.values())]
    own = rows.select("id", "tag", "part", F.lit(1).alias("rows"), sum(bits[1:], bits[0]).alias("bits"))
    copied = copies(rows).select("id", "tag", "part", F.lit(0).alias("rows"), F.lit(1 << len(filters)).alias("bits"))
    each = own.unionByName(copied).groupBy("id", "tag", "part").agg(F.sum("rows").alias("n"), F.bit_or("bits").alias("bits"))
    known = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("l_id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")
    )
    # rows without an id match no label; they go by their texts, so that no task gets all of them
    each = each.withColumns({"l_id": F.coalesce("id", "tag"), "none": F.col("id").isNull()})
    told = each.join(known.withColumn("none", F.lit(False)), ["l_id", "none"], "left")
    fails = F.concat(*[F.when(F.col("bits").bitwiseAND(1 << k) != 0, F.lit(c)).otherwise(F.lit("")) for k, c in enumerate(letters)])
    counted = told.groupBy("part", "bits").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.coalesce("good", F.lit(0))).alias("good"),
        F.sum(F.col("n") * F.coalesce("toxic", F.lit(0))).alias("toxic"),
    )
    return counted.select("part", fails.alias("fails"), "n", "good", "toxic")


def orders(counted: DataFrame, letters: str) -> DataFrame:
    """One row per part, order of all filters and step: what that step does, and its share over all orders."""
    every = [F.lit("".join(order)) for order in permutations(letters)]
    steps = counted.withColumn("filter_order", F.explode(F.array(*every))).withColumn(
        "step", F.explode(F.sequence(F.lit(1), F.lit(len(letters))))
    )
    own = F.substring("filter_order", F.col("step"), F.lit(1))
    before = F.substring("filter_order", F.lit(1), F.col("step") - 1)
    fails, there = F.contains("fails", own), F.call_function("translate", before, F.col("fails"), F.lit("")) == before
    share = F.lit(factorial(len(letters))) / F.greatest(F.length("fails"), F.lit(1))

    def total(value: Column, when: Column, name: str) -> Column:
        return F.sum(F.when(when, value).otherwise(F.lit(0))).cast("long").alias(name)

    return steps.groupBy("part", "filter_order", "step").agg(
        total(F.col("n"), there & ~fails, "kept"), total(F.col("n"), there & fails, "removed"),
        total(F.col("n"), ~there & fails, "redundant"), total(F.col("n"), F.col("fails") == own, "unique_fails"),
        total(F.col("good"), there & fails, "good_lost"), total(F.col("toxic"), there & fails, "toxic_lost"),
        total((F.col("n") * share).cast("long"), fails, "shapley"),
    )


def audit(docs: DataFrame, labels: DataFrame, **names) -> DataFrame:
    """The default rules with copies as filter E, in all 120 orders."""
    return orders(stage(combinations(docs, labels, **names), "combinations"), "ABCDE")
