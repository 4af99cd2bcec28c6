from pyspark.sql import functions as F

from tidemark.operators import summary


def test_sketches_of_days_unite_to_those_of_a_range(spark, tmp_path):
    ids = spark.range(60_000, numPartitions=6)
    posts = ids.selectExpr(
        "if(id % 3 = 0, '#x', concat('#', id % 5)) as hashtag", "concat('d', id % 7) as date", "concat('u', id % 20011) as username",
    ).unionByName(spark.createDataFrame([("#none", "d0", None), ("#one", "d0", "u1"), ("#one", "d1", "u1")], "hashtag string, date string, username string"))
    folder = str(tmp_path / "sketches")
    summary.user_sketches(posts).write.parquet(folder)
    stored = spark.read.parquet(folder)
    exact = {r["hashtag"]: r for r in posts.groupBy("hashtag").agg(F.count("*").alias("n"), F.count_distinct("username").alias("u")).collect()}
    found = {r["hashtag"]: r for r in summary.united_users(stored).collect()}
    assert found.keys() == exact.keys()
    for tag, row in exact.items():
        assert found[tag]["posts"] == row["n"]
        assert abs(found[tag]["unique_users"] - row["u"]) <= 0.03 * row["u"], tag
    assert (found["#none"]["unique_users"], found["#one"]["unique_users"]) == (0, 1)
    # uniting in steps, and one pass over the posts, give the same estimate
    halves = [summary.united_users(stored.where(F.col("date").isin(*days)), ["hashtag"]) for days in (["d0", "d1", "d2"], ["d3", "d4", "d5", "d6"])]
    steps = summary.united_users(halves[0].unionByName(halves[1]))
    once = summary.united_users(summary.user_sketches(posts, ["hashtag"]))
    for other in (steps, once):
        assert all(abs(r["unique_users"] - found[r["hashtag"]]["unique_users"]) <= 0.01 * found[r["hashtag"]]["unique_users"] for r in other.collect())
    some = summary.united_users(stored.where("date in ('d1', 'd2')")).where("hashtag = '#x'").first()["unique_users"]
    true = posts.where("date in ('d1', 'd2') and hashtag = '#x'").select("username").distinct().count()
    assert abs(some - true) <= 0.03 * true
