"""Shards by rendezvous hashing of record keys.

Every pair of a key and a shard has a number u in (0, 1) from a hash of both; the pair costs -ln(u) / weight, and a record
goes to the shard where its key costs least. So shards get shares in proportion to their weights, a record's shard depends
on its key, the number of shards and their weights alone, and a shard that is added takes records only into itself:
no cost of another shard changes.

Slots number the records of a shard from 0 without gaps, by key, checksum and size of the text. Only these few numbers per
record are sorted, in ranges that cut through shards; ranges count their rows and start where the ranges before end, so a shard
of any size is numbered by as many tasks as hold it.

Defined results: null keys are one key, the text ``null`` for the hash, and have the last slots of their shard. A null text has
no bytes and checksum 0. Repeated rows have a slot each. A shard of weight 0 gets nothing. An empty table has no
rows. Other columns aren't read by ``place``; ``write_shards`` keeps them, and its own column takes another name where one clashes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.series import numbered
from tidemark.session import run_folder, sized_shuffles, stage

SEED = "shard"
OVERHEAD = 16
BITS = 52
ROW_BYTES = 64


def uniform(key: Column, shard: Column, seed: str = SEED) -> Column:
    """A number in (0, 1) from the md5 of seed, key and shard."""
    pair = F.concat_ws("|", F.lit(seed), F.coalesce(key.cast("string"), F.lit("null")), shard.cast("string"))
    drawn = F.conv(F.substring(F.md5(pair), 1, BITS // 4), 16, 10).cast("long")
    return (drawn + F.lit(0.5)) / F.lit(float(1 << BITS))


def cost(key: Column, shard: Column, weight: Column, seed: str = SEED) -> Column:
    return -F.ln(uniform(key, shard, seed)) / weight


def cheapest(key: Column, weights: Sequence[float], seed: str = SEED) -> Column:
    """Struct of the least cost and the shard that has it, the smaller one on a tie."""
    if not any(w > 0 for w in weights) or any(w < 0 for w in weights):
        raise ValueError("shards need weights of 0 or more, one above 0")
    shards = F.array(*[F.struct(F.lit(k).alias("shard"), F.lit(float(w)).alias("weight")) for k, w in enumerate(weights) if w > 0])
    return F.array_min(F.transform(
        shards, lambda s: F.struct(cost(key, s["shard"], s["weight"], seed).alias("cost"), s["shard"].alias("shard"))
    ))


def place(
    docs: DataFrame, weights: Sequence[float], key: str = "doc_id", text: str = "text", grown: float | None = 1.0, seed: str = SEED,
) -> DataFrame:
    """(key, size, text_crc32, law, shard, slot, grown_shard) of every row.

    ``grown`` is the weight of one more shard, whose choice is ``grown_shard``; without it that column is null.
    """
    spark, name = docs.sparkSession, key
    data = F.coalesce(F.col(text), F.lit("")).cast("binary")
    rows = docs.select(
        F.col(key).alias("key"), (F.octet_length(data) + OVERHEAD).cast("long").alias("size"), F.crc32(data).alias("text_crc32"),
        cheapest(F.col(key), weights, seed).alias("best"),
    )
    more = F.lit(None).cast("int")
    if grown:
        new = F.lit(len(weights))
        more = F.when(cost(F.col("key"), new, F.lit(float(grown)), seed) < F.col("best.cost"), new).otherwise(F.col("best.shard"))
    # the place in the scan tells repeated rows apart, so that ranges can cut through them
    rows = stage(rows.select(
        "key", "size", "text_crc32", F.col("best.shard").alias("shard"), more.alias("grown_shard"), F.col("key").isNull().alias("_last"),
        F.monotonically_increasing_id().alias("_row"),
    ), "placed")
    before, starts = 0, []
    sizes = {r["shard"]: r["count"] for r in rows.groupBy("shard").count().collect()}  # a row per shard
    for shard in sorted(sizes):
        starts += [F.lit(shard), F.lit(before)]
        before += sizes[shard]
    if not starts:
        starts = [F.lit(0), F.lit(0)]
    with sized_shuffles(spark, before * ROW_BYTES):
        placed = numbered(rows, ("shard", "_last", "key", "text_crc32", "size", "_row", "grown_shard"))
    first = F.create_map(*starts)[F.col("shard")]
    return placed.select(
        F.col("key").alias(name), "size", "text_crc32", F.lit("key").alias("law"), "shard",
        (F.col("_index") - first).cast("long").alias("slot"), "grown_shard",
    )


def write_shards(
    docs: DataFrame, weights: Sequence[float], folder: str | None = None, key: str = "doc_id", seed: str = SEED,
) -> DataFrame:
    """Write whole rows, a folder per shard, and return the table as it is read back.

    Rows are dealt by ranges of shard and key: a shard is written by as many tasks as it fills, each task to few shards.
    """
    folder = folder or run_folder(docs.sparkSession, "shards")
    name = "shard"
    while name in docs.columns:
        name = f"_{name}"
    dealt = docs.withColumn(name, cheapest(F.col(key), weights, seed)["shard"])
    dealt.repartitionByRange(F.col(name), F.col(key), F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns])).write.partitionBy(name).parquet(folder)
    return docs.sparkSession.read.schema(dealt.schema).parquet(folder)
