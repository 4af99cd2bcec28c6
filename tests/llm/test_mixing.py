import math

from pyspark.sql import functions as F

from tidemark.llm import mixing


def test_columns_and_determinism(odd):
    a = mixing.mix(odd, power=0.0)
    b = mixing.mix(odd.repartition(5), power=0.0)
    assert a.columns == [*odd.columns, "_copy", "_order"]
    rows = lambda df: sorted(map(repr, df.select("doc_id", "source", "_copy", "_order").collect()))
    assert rows(a) == rows(b)


def test_counts_follow_the_rates(spark):
    docs = spark.range(30000).select(
        F.col("id").alias("doc_id"), F.expr("if(id % 10 = 0, 'small', 'large')").alias("source"), F.lit("abcd").alias("text")
    )
    mixed = mixing.mix(docs, weights={"small": 0.5, "large": 0.5})
    times = {r["source"]: r["count"] for r in mixed.groupBy("source").count().collect()}
    assert abs(times["small"] - 15000) < 6 * math.sqrt(15000) and abs(times["large"] - 15000) < 6 * math.sqrt(15000)
    spread = mixed.where("source = 'small'").groupBy("doc_id").count().agg(F.var_samp("count"), F.max("count")).first()
    assert 3 < spread[0] < 6 and spread[1] < 25  # Poisson of mean 5, less those drawn 0 times


def test_large_rates_are_sums_of_parts(spark):
    docs = spark.createDataFrame([(i, "r", "x") for i in range(200)] + [(-1, "l", "y" * 200000)], "doc_id long, source string, text string")
    mixed = mixing.mix(docs, weights={"r": 1.0})
    per = [r["count"] for r in mixed.groupBy("doc_id").count().collect()]
    assert len(per) == 200 and abs(sum(per) / 200 - 1001) < 12  # a weight of 0 leaves a source out


def test_weightless_and_empty(spark, empty):
    blank = spark.createDataFrame([(i, None, None) for i in range(50)], "doc_id long, source string, text string")
    assert 20 < mixing.mix(blank).count() < 90  # rate 1
    assert mixing.mix(empty).count() == 0
