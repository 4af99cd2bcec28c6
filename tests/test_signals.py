import random
import re
from collections import Counter
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from registry import queries
from tidemark.operators import bootstrap, buckets, features, series, summary


def at(hour, minute=0, day=1):
    return datetime(2024, 1, day, hour, minute)


@pytest.fixture
def signal(spark):
    rows = [(at(5, 30), "a", 1.0, "#x"), (at(5, 40), "b", 3.0, "#y"), (at(9, 0), "c", 5.0, "#x")]
    return spark.createDataFrame(rows, "timestamp timestamp, uid string, composite_signal double, hashtag_primary string")


def shown(df):
    return df.withColumn("timestamp", F.date_format("timestamp", "dd HH:mm"))


def test_zscore(spark):
    rng = np.random.default_rng(1)
    rows = spark.createDataFrame([(float(x), 2.0) for x in rng.normal(5, 3, 500)], "x double, flat double")
    done = features.zscore(rows, ["x", "flat"]).select(
        F.avg("x_z"), F.stddev_pop("x_z"), F.min("flat_z"), F.max("flat_z")
    ).first()
    assert done[0] == pytest.approx(0, abs=1e-12) and done[1] == pytest.approx(1)
    assert done[2] == done[3] == 0
    one = features.zscore(rows.limit(1), ["x"]).first()
    assert one["x_z"] == 0


def test_rounding_noise_is_not_spread(spark):
    rows = spark.range(1000).select((F.lit(0.1) + F.rand(1) * 1e-17).alias("x"))
    assert features.zscore(rows, ["x"]).where("abs(x_z) > 1e-9").count() == 0


def test_zscore_has_no_unpartitioned_window_or_join(spark, plan):
    text = plan(features.zscore(spark.range(10).selectExpr("id * 1.0 as x"), ["x"]))
    assert "Window" not in text and "NestedLoop" not in text and "Cartesian" not in text


def test_composite_with_frozen_moments(spark):
    rows = spark.createDataFrame([(3.0, 8.0)], "polarity double, engagement double")
    done = features.composite_signal(
        rows, {"polarity": 0.5, "engagement": 2.0}, {"polarity": (1.0, 2.0), "engagement": (8.0, 0.0)}
    )
    assert done.first()["composite_signal"] == 0.5


@pytest.mark.parametrize("freq, micros", [("2h", 7200), ("1H", 3600), ("15T", 900), ("15min", 900), ("s", 1), ("1D", 86400)])
def test_widths(freq, micros):
    assert buckets.width_micros(freq) == micros * 1_000_000


@pytest.mark.parametrize("freq", ["", "h2", "0h", "1M", "-1h"])
def test_bad_widths(freq):
    with pytest.raises(ValueError):
        buckets.width_micros(freq)


def test_buckets_fill_gaps(signal):
    found = shown(buckets.aggregate_signals(signal, "2h", method="none")).orderBy("timestamp").collect()
    assert [(r["timestamp"], r["signal"], r["n"]) for r in found] == [
        ("01 04:00", 2.0, 2), ("01 06:00", None, 0), ("01 08:00", 5.0, 1),
    ]


def test_odd_widths_count_from_the_first_midnight(signal):
    found = shown(buckets.aggregate_signals(signal, "7h", method="none")).orderBy("timestamp").collect()
    assert [(r["timestamp"], r["n"]) for r in found] == [("01 00:00", 2), ("01 07:00", 1)]


def test_buckets_by_hashtag(signal):
    seen = buckets.aggregate_signals(signal, "1h", by=["hashtag_primary"], method="none")
    assert seen.count() == 3
    full = buckets.aggregate_signals(signal, "1h", by=["hashtag_primary"], method="none", gaps=True)
    assert full.where("hashtag_primary = '#x'").count() == 5 and full.agg(F.sum("n")).first()[0] == 3


def test_long_gap_is_unfolded_in_pieces(spark):
    rows = spark.createDataFrame([(at(0), "a", 1.0), (at(5), "b", 1.0)], "timestamp timestamp, uid string, composite_signal double")
    full = buckets.aggregate_signals(rows, "1s", method="none")
    assert full.count() == full.select("timestamp").distinct().count() == 5 * 3600 + 1


def test_poisson_weights_are_poisson(spark):
    rows = spark.range(4000).select((F.col("id") % 1).alias("g"), F.col("id").alias("k"), F.lit(1.0).alias("_x"))
    sums = bootstrap.replicate_sums(rows, ["g"], ["k"], 50).where("_b >= 0").toPandas()
    assert len(sums) == 50 and abs(sums["_w"].mean() - 4000) < 40 and 35 < sums["_w"].std() < 95
    assert sums["_w"].nunique() > 30


def test_interval_matches_theory(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(0, 1, 3000)
    rows = spark.createDataFrame([(at(1), str(i), float(v)) for i, v in enumerate(x)], "timestamp timestamp, uid string, composite_signal double")
    r = buckets.aggregate_signals(rows, "1h").first()
    half = 1.96 * x.std() / np.sqrt(len(x))
    assert r["signal"] == pytest.approx(x.mean()) and r["n"] == 3000
    assert r["ci_lo"] == pytest.approx(x.mean() - half, abs=half * 0.35)
    assert r["ci_hi"] == pytest.approx(x.mean() + half, abs=half * 0.35)


def test_intervals_of_small_buckets(spark):
    rows = spark.createDataFrame(
        [(at(1), "a", 2.0), (at(3), "b", 4.0), (at(3, 1), "c", 4.0), (at(4), "d", None)],
        "timestamp timestamp, uid string, composite_signal double",
    )
    for method in ("poisson",):
        found = buckets.aggregate_signals(rows, "1h", method=method).orderBy("timestamp").collect()
        assert [(r["signal"], r["n"], r["ci_lo"], r["ci_hi"]) for r in found] == [
            (2.0, 1, 2.0, 2.0), (None, 0, None, None), (4.0, 2, 4.0, 4.0), (None, 0, None, None),
        ]


def test_intervals_resemble_resampling(spark):
    """The same rows resampled with replacement by numpy."""
    x = np.random.default_rng(7).normal(2.0, 3.0, 400)
    rows = spark.createDataFrame([(at(1), str(i), float(v)) for i, v in enumerate(x)], "timestamp timestamp, uid string, composite_signal double")
    rng = np.random.default_rng(42)
    means = [x[rng.integers(0, 400, size=400)].mean() for _ in range(2000)]
    r = buckets.aggregate_signals(rows, "1h").first()
    assert (r["ci_lo"], r["ci_hi"]) == pytest.approx(tuple(np.quantile(means, [0.025, 0.975])), abs=0.1)


def test_replicate_sums_match_the_weights(spark, monkeypatch):
    """Also where tasks send on their sums in between, and with null groups and values."""
    monkeypatch.setattr(bootstrap, "SLICE", 7)
    monkeypatch.setattr(bootstrap, "HELD_GROUPS", 2)
    rows = [(None if i % 3 == 0 else f"g{i % 3}", at(i % 2), str(i), None if i % 11 == 0 else i / 7) for i in range(90)]
    frame = spark.createDataFrame(rows, "g string, t timestamp, uid string, _x double").coalesce(2)
    found = {(r["g"], r["t"], r["_b"]): (r["_w"], r["_wx"]) for r in bootstrap.replicate_sums(frame, ["g", "t"], ["uid"], 5).collect()}
    seeds = {r["uid"]: r["s"] for r in frame.select("uid", bootstrap.row_seed(["uid"]).alias("s")).collect()}
    expected = {}
    for g, t, uid, x in rows:
        for b, factor in enumerate([0, *bootstrap.multipliers(5)], start=-1):
            draw = seeds[uid] * factor % bootstrap.LEHMER_PRIME
            weight = 0 if x is None else 1 if b == -1 else sum(draw > step for step in bootstrap.poisson_steps())
            w, wx = expected.get((g, t, b), (0, 0.0))
            expected[g, t, b] = (w + weight, wx + weight * (x or 0))
    expected = {k: v for k, v in expected.items() if v[0] or k[2] == -1}
    assert found.keys() == expected.keys()
    assert all(found[k] == pytest.approx(expected[k]) for k in expected)


def test_gaps_of_a_null_group(spark):
    rows = spark.createDataFrame(
        [(at(1), None, "a", 2.0), (at(3), None, "b", 4.0), (at(1), "x", "c", 1.0)],
        "timestamp timestamp, tag string, uid string, composite_signal double",
    )
    found = buckets.aggregate_signals(rows, "1h", by=["tag"], method="none", gaps=True).orderBy("tag", "timestamp").collect()
    assert [(r["tag"], r["signal"], r["n"]) for r in found] == [(None, 2.0, 1), (None, None, 0), (None, 4.0, 1), ("x", 1.0, 1)]


def test_sorted_by_time(spark):
    rows = spark.range(200).select(F.timestamp_seconds(F.col("id") * 7919 % 200).alias("timestamp")).repartition(5)
    times = [r[0] for r in series.sort_by_time(rows).collect()]
    assert times == sorted(times) and len(times) == 200


def test_bootstrap_combines_before_the_shuffle(signal, plan):
    rows = signal.select("timestamp", "uid", F.col("composite_signal").alias("_x"))
    text = plan(bootstrap.replicate_sums(rows, ["timestamp"], ["uid"], 200))
    assert text.index("Exchange") < text.index("partial_sum") and text.count("Exchange") == 1
    assert "Generate" not in text


@pytest.mark.parametrize("rows, target", [(3, 5), (5, 5), (6, 5), (1000, 7), (2, 2)])
def test_downsample(spark, rows, target):
    table = spark.range(rows).select((rows - F.col("id")).alias("timestamp")).repartition(3)
    found = sorted(r[0] for r in series.downsample(table, target).collect())
    whole = list(range(1, rows + 1))
    expected = whole if rows <= target else [whole[i] for i in np.linspace(0, rows - 1, target).astype(int)]
    assert found == expected


def test_downsample_of_ties_and_payload(spark, plan):
    """Equal keys keep their number of places; the numbering holds no payload."""
    table = spark.range(900).select((F.col("id") % 3).alias("timestamp"), F.col("id").alias("payload")).repartition(3)
    found = series.downsample(table, 9)
    assert sorted(r["timestamp"] for r in found.collect()) == [0, 0, 0, 1, 1, 1, 2, 2, 2]
    assert found.select("payload").distinct().count() == 9
    assert "payload" not in plan(series.numbered(table, ["timestamp"]))


def test_summary(spark):
    rows = spark.createDataFrame(
        [(["#a", "#b"], "u", 1, 2, 3, at(1)), (["#a"], "u", 3, 2, 1, at(2)), (["#a"], "v", 5, 2, 2, None), ([], "w", 1, 1, 1, at(3))],
        "_hashtags_list array<string>, username string, likes int, retweets int, replies int, timestamp timestamp",
    )
    found = {r["hashtag"]: r for r in summary.summarize_by_hashtag(summary.explode_hashtags(rows)).collect()}
    assert set(found) == {"a", "b"}
    a = found["a"]
    assert (a["total_tweets"], a["unique_users"], a["avg_likes"], a["avg_replies"]) == (3, 2, 3.0, 2.0)
    assert (a["date_range"]["start"], a["date_range"]["end"]) == (at(1), at(2))


def test_downsample_computes_rows_once(spark):
    unsteady = F.udf(lambda i: i + random.random(), "double").asNondeterministic()  # like a mean added up in another order
    table = spark.range(500).select(F.timestamp_seconds("id").alias("timestamp"), unsteady("id").alias("signal"))
    found = series.downsample(table, 40, order_by=("timestamp", "signal")).collect()
    assert len(found) == 40


def test_composite_query_blends_the_text_direction_too(spark, tmp_path):
    """The query held against plain counting and power steps: 0.4 polarity, 0.3 engagement and 0.3 of the texts' leading direction."""
    start = datetime(2024, 1, 1)
    kinds = ["click", "view", "error"]
    events = [(i, start + timedelta(minutes=7 * i), i % 5, kinds[i % 3], 1.5 * i, f'{{"k": {i % 4}}}') for i in range(40)]
    documents = [(i, f"word{i % 4} up the hill word{i % 3}", ("de", "en")[i % 2], f"src{i % 3}", 30 + i) for i in range(24)]
    turns = [(i, i % 3, ("user", "bot")[i % 2], f"say word{i % 5} again") for i in range(20)]
    for name, rows, schema in (
        ("events", events, "event_id long, ts timestamp, user_id long, event_type string, value double, props string"),
        ("documents", documents, "doc_id long, text string, lang string, source string, n_chars long"),
        ("conversations", turns, "conv_id long, turn long, role string, text string"),
    ):
        spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    sf = str(tmp_path)
    posts = queries.scored(spark, sf).select("source_file", "uid", "content", "polarity", "engagement").collect()
    counts = []
    for post in posts:
        words = re.findall(r"\w+", post["content"].lower())
        counts.append(Counter(words + [f"{a} {b}" for a, b in zip(words, words[1:])]))
    terms = sorted(set().union(*counts))
    tf = np.array([[c[t] for t in terms] for c in counts], dtype=float)
    w = tf * (np.log((1 + len(tf)) / (1 + (tf > 0).sum(axis=0))) + 1)
    w /= np.maximum(np.sqrt((w * w).sum(axis=1, keepdims=True)), 1e-300)
    v = np.full(len(terms), len(terms) ** -0.5)
    for _ in range(20):
        v = w.T @ (w @ v)
        v /= np.sqrt(v @ v)
    parts = {"polarity": [p["polarity"] for p in posts], "engagement": [p["engagement"] for p in posts], "svd_1": w @ v}
    z = {name: (np.array(x) - np.mean(x)) / np.std(x) for name, x in parts.items()}
    blend = 0.4 * z["polarity"] + 0.3 * z["engagement"] + 0.3 * z["svd_1"]
    expected = {(p["source_file"], p["uid"]): x for p, x in zip(posts, blend, strict=True)}
    found = {(r["source_file"], r["uid"]): r["composite_signal"] for r in queries.QUERIES["composite_signal"](spark, sf).collect()}
    assert found == pytest.approx(expected, abs=2e-6) and len(found) > 60
