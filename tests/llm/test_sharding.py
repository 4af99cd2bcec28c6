import hashlib
import math
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.llm import sharding


def plain_cost(key, shard, weight):
    name = "null" if key is None else key
    u = (int(hashlib.md5(f"shard|{name}|{shard}".encode()).hexdigest()[:13], 16) + 0.5) / 2.0**52
    return -math.log(u) / weight


def plain_shard(key, weights):
    return min((plain_cost(key, k, w), k) for k, w in enumerate(weights) if w)[1]


def plain_places(rows, weights):
    found = []
    for key, text, *_ in rows:
        data = (text or "").encode()
        found.append([plain_shard(key, weights), key is None, key or 0, zlib.crc32(data), len(data) + 16, plain_shard(key, [*weights, 1.0]), key])
    found.sort(key=lambda r: r[:5])
    slots, out = Counter(), []
    for shard, _, _, crc, size, grown, key in found:
        out.append((key, size, crc, "key", shard, slots[shard], grown))
        slots[shard] += 1
    return out


COLUMNS = ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]


@pytest.mark.parametrize("weights", [[1.0] * 40, [1.0, 0.0, 3.5], [2.0]])
def test_equals_brute_force(odd, odd_rows, same_rows, weights):
    same_rows(sharding.place(odd, weights), plain_places(odd_rows, weights), *COLUMNS)


def test_one_more_shard_takes_rows_only_into_itself(spark):
    docs = spark.range(20_000).selectExpr("id as doc_id", "'x' as text")
    found = sharding.place(docs, [1.0] * 9)
    moved = found.where("shard <> grown_shard")
    assert {r[0] for r in moved.select("grown_shard").distinct().collect()} == {9}
    assert 1800 < moved.count() < 2200
    # the same choice as with ten shards from the start
    ten = docs.select("doc_id", sharding.cheapest(F.col("doc_id"), [1.0] * 10)["shard"].alias("ten"))
    assert found.join(ten, "doc_id").where("grown_shard <> ten").count() == 0


def test_shares_follow_weights(spark):
    docs = spark.range(30_000).selectExpr("id as doc_id", "'x' as text")
    found = {r["shard"]: r["count"] for r in sharding.place(docs, [1.0, 2.0, 3.0]).groupBy("shard").count().collect()}
    assert all(abs(found[k] - 5000 * (k + 1)) < 400 for k in range(3))


def test_slots_have_no_gaps_where_one_key_is_common(spark):
    docs = spark.range(6000).selectExpr("if(id % 3 = 0, null, if(id % 3 = 1, 7, id)) as doc_id", "'same' as text").repartition(6)
    found = sharding.place(docs, [1.0] * 5)
    told = found.groupBy("shard").agg(F.count("*").alias("n"), F.min("slot").alias("lo"), F.max("slot").alias("hi"), F.countDistinct("slot").alias("d"))
    assert all((r["lo"], r["hi"], r["d"]) == (0, r["n"] - 1, r["n"]) for r in told.collect())


def test_written_shards_hold_all_rows_and_columns(spark, odd, tmp_path):
    clashing = odd.withColumn("shard", F.lit("own"))
    back = sharding.write_shards(clashing, [1.0, 1.0, 2.0], str(tmp_path / "shards"))
    assert back.columns == [*clashing.columns, "_shard"]
    assert back.drop("_shard").exceptAll(clashing).isEmpty() and back.count() == clashing.count()
    assert back.where(sharding.cheapest(F.col("doc_id"), [1.0, 1.0, 2.0])["shard"] != F.col("_shard")).isEmpty()


def test_empty_table_and_bad_weights(empty, odd):
    assert sharding.place(empty, [1.0] * 40).count() == 0
    assert sharding.place(odd, [1.0], grown=None).where("grown_shard is not null").isEmpty()
    for weights in ([], [0.0], [1.0, -1.0]):
        with pytest.raises(ValueError):
            sharding.cheapest(F.col("doc_id"), weights)
