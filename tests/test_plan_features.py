from pyspark.sql import functions as F

from tidemark.operators import features, svd


def test_scores_stand_beside_term_counts(spark, plan):
    """No join and no shuffle of posts between the fit and the scored rows."""
    posts = spark.createDataFrame(
        [("s", str(i), f"buy now w{i % 7} w{i % 5}" if i % 9 else "", i) for i in range(60)],
        "source_file string, uid string, content string, likes int",
    ).withColumns({"retweets": F.lit(1), "replies": F.lit(0)})
    scored = features.score_reactions(features.score_text(posts))
    model = svd.fit_svd(scored, ["source_file", "uid"], "content", 2, 20, carry=["polarity", "engagement"])
    carried = model.carried()
    assert "Exchange" not in plan(carried) and "Join" not in plan(carried)
    assert carried.columns == ["source_file", "uid", "polarity", "engagement", "svd_1", "svd_2"] and carried.count() == 60
    joined = svd.with_svd(posts.select("source_file", "uid"), model).orderBy("uid").collect()
    for a, b in zip(joined, carried.orderBy("uid").collect(), strict=True):
        assert (a["svd_1"], a["svd_2"]) == (b["svd_1"], b["svd_2"])
    assert {r["svd_1"] for r in carried.where("polarity = 0").collect()} == {0.0}
