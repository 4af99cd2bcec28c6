import pytest
from pyspark.sql import functions as F

from tidemark.operators import clean, dedupe


@pytest.fixture
def raw(spark):
    return spark.createDataFrame(
        [
            ("ann", "2024-01-01T00:00:00Z", "Buy  #B #a", "3", None, "x"),
            ("ann", "2024-01-01 00:00:00", "Buy #B #a", "4", "@Z", "y"),
            ("bob", "junk", "", "n/a", "", "x"),
        ],
        "username string, timestamp string, content string, likes string, mentions string, extra string",
    )


def test_standardize(raw):
    done = clean.standardize(raw)
    assert set(done.columns[13:-1]) == {"mentions", "extra", "hashtags"}
    assert done.columns[:13] == list(clean.CORE_COLUMNS) and done.columns[-1] == "source_file"
    rows = done.orderBy("username", "likes").collect()
    assert [r["likes"] for r in rows] == [3, 4, 0] and rows[0]["retweets"] == 0
    assert rows[0]["_hashtags_list"] == ["#a", "#b"] and rows[0]["hashtag_primary"] == "#a"
    assert rows[1]["_mentions_list"] == ["@z"] and rows[0]["date"] == "2024-01-01"
    assert rows[2]["hashtag_primary"] == "" and rows[2]["date"] is None
    assert rows[0]["uid"] == rows[1]["uid"] != rows[2]["uid"]


def test_repeats(raw):
    kept = clean.clean_posts(raw, order_by=["likes"])
    assert sorted(r["likes"] for r in kept.collect()) == [0, 3]
    again = dedupe.drop_repeats(kept, order_by=["likes"])
    assert again.count() == kept.count()


def test_repeats_per_file_or_globally(raw):
    files = raw.withColumn("source_file", F.col("extra"))
    assert clean.clean_posts(files, order_by=["likes"]).count() == 3
    assert clean.clean_posts(files, scope="global", order_by=["likes"]).count() == 2
    with pytest.raises(ValueError):
        clean.clean_posts(files, scope="day")


def test_repeats_are_cut_before_the_shuffle(raw, plan):
    text = plan(dedupe.drop_repeats(clean.standardize(raw), order_by=["likes"]))
    assert text.count("WindowGroupLimit") == 2 and text.count("hashpartitioning") == 1


def test_same_content(spark):
    rows = spark.createDataFrame(
        [("t", "a", "x", 2), ("t", "a", "x", 1), ("t", "b", "x", 3), ("u", "a", "x", 4)],
        "hashtag string, username string, content string, n int",
    )
    kept = dedupe.drop_same_content(rows, ["n"])
    assert sorted(r["n"] for r in kept.collect()) == [1, 3, 4]


def test_cap_with_one_hot_hashtag(spark):
    rows = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, "rare").otherwise("hot").alias("hashtag"),
        (5000 - F.col("id")).alias("timestamp"), F.col("id").cast("string").alias("uid"),
    )
    kept = dedupe.cap_per_group(rows, 40).groupBy("hashtag").agg(F.count("*").alias("n"), F.max("timestamp").alias("t"))
    found = {r["hashtag"]: (r["n"], r["t"]) for r in kept.collect()}
    expected = sorted(5000 - i for i in range(5000) if i % 3)[39]
    assert found["hot"] == (40, expected) and found["rare"][0] == 40


def test_filters(spark):
    rows = spark.createDataFrame([("a", "x"), ("", "x"), ("a", ""), ("a", None)], "username string, content string")
    assert clean.complete_records(rows).count() == 1
    timed = rows.withColumn("timestamp", F.current_timestamp())
    assert clean.drop_incomplete(timed).count() == 3
    urls = spark.createDataFrame([(["https://a.b", "/c", "http://twitter.com/x", "ftp://d"],)], "u array<string>")
    assert urls.select(clean.external_urls(F.col("u"))).first()[0] == ["https://a.b"]
