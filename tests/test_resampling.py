import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import buckets, resampling

COLUMNS = "g string, k long, x double"


@pytest.mark.parametrize(("n", "block"), [(1, 16), (16, 16), (17, 16), (1000, 16), (5000, 4096), (10_000_000, 65_536)])
def test_draws_of_all_blocks_sum_to_the_size(n, block):
    blocks = range(-(-n // block))
    draws = np.stack([resampling.block_draws("g", n, at, block, 30) for at in blocks])
    assert (draws.sum(axis=0) == n).all() and (draws >= 0).all()
    sizes = np.array([min((at + 1) * block, n) - at * block for at in blocks])
    assert np.abs(draws.mean(axis=1) - sizes).max() < 6 * np.sqrt(sizes.max() / 30) + 1


def test_binomials_follow_their_distribution():
    for draws, share in ((40, 0.3), (2048, 0.5), (100_000, 0.25)):
        found = np.concatenate([resampling.binomials(np.full(400, draws), share, f"n{i}") for i in range(5)])
        sd = np.sqrt(draws * share * (1 - share))
        assert abs(found.mean() - draws * share) < 5 * sd / np.sqrt(2000) and 0.9 < found.std() / sd < 1.1


def test_weights_of_a_block_add_up_and_are_even():
    draws = np.array([0, 1, 7, 5000])
    weights = resampling.block_weights("g", 3, 50, draws)
    assert weights.sum(axis=1).tolist() == draws.tolist() and weights[3].min() > 50 and weights[3].max() < 160


def plain(rows, replicates, block):
    """The same draws, a bucket at a time."""
    out = {}
    groups = {}
    for g, k, x in rows:
        groups.setdefault(g, []).append((k, x))
    for g, members in groups.items():
        values = np.array([x for _, x in sorted(members, key=lambda m: m[0]) if x is not None])
        n = len(values)
        if not n:
            out[g] = (None, 0, None, None)
            continue
        means = np.zeros(replicates)
        for at in range(-(-n // block)):
            own = values[at * block : (at + 1) * block]
            draws = resampling.block_draws("null" if g is None else g, n, at, block, replicates)
            means += resampling.block_weights("null" if g is None else g, at, len(own), draws) @ own
        out[g] = (values.mean(), n, *np.quantile(means / n, [0.025, 0.975]))
    return out


def test_intervals_of_groups_with_nulls(spark):
    rng = np.random.default_rng(1)
    rows = [(g, i, float(rng.normal())) for i in range(200) for g in ("a", None)] + [("b", 900, None), ("c", 901, 2.5), ("a", 902, None)]
    df = spark.createDataFrame(rows, COLUMNS).withColumnRenamed("x", "_x").repartition(3)
    found = {r["g"]: tuple(r)[1:] for r in resampling.resampled_intervals(df, ["g"], ["k"], 50, block=16).collect()}
    expected = plain(rows, 50, 16)
    assert set(found) == set(expected)
    for g, row in expected.items():
        assert found[g] == pytest.approx(row), g
    assert found["c"] == (2.5, 1, 2.5, 2.5) and found["b"] == (None, 0, None, None)


def test_one_large_group_is_spread(spark, plan):
    df = spark.range(400_000).selectExpr("'same' as g", "id as k", "cast(id % 7 as double) as _x")
    placed = resampling.placed_rows(df, ["g"], ["k"])
    sums = resampling.replicate_sums(placed, ["g"], 20, 4096)
    rows = sums.collect()
    assert [r["_w"] for r in rows] == [400_000] * 20
    means = np.array([r["_wx"] / r["_w"] for r in rows])
    assert abs(means.mean() - 3) < 0.01 and 0.001 < means.std() < 0.008  # 2 / sqrt(n) is 0.003
    # a task gets blocks, not the group
    spread = placed.withColumn("_block", F.floor(F.col("_i") / 4096)).repartition(8, "g", "_block").groupBy(F.spark_partition_id()).count()
    assert spread.agg(F.max("count")).first()[0] < 250_000


def test_intervals_agree_with_many_replicates_of_plain_resampling(spark):
    rng = np.random.default_rng(2)
    values = rng.exponential(size=300)
    df = spark.createDataFrame([("a", i, float(v)) for i, v in enumerate(values)], COLUMNS).withColumnRenamed("x", "_x")
    _, signal, n, low, high = resampling.resampled_intervals(df, ["g"], ["k"], 1000, block=32).first()
    means = values[rng.integers(0, 300, (4000, 300))].mean(axis=1)
    assert (signal, n) == (pytest.approx(values.mean()), 300)
    assert (low, high) == pytest.approx(np.quantile(means, [0.025, 0.975]), abs=0.03)


def test_series_with_gaps(spark):
    rows = [("2024-01-01 00:10:00", "u1", 1.0), ("2024-01-01 00:20:00", "u2", 3.0), ("2024-01-01 02:05:00", "u3", 5.0)]
    features = spark.createDataFrame(rows, "t string, uid string, composite_signal double").selectExpr("timestamp(t) as timestamp", "uid", "composite_signal")
    found = buckets.aggregate_signals(features, "1h", replicates=40, method="resample").orderBy("timestamp").collect()
    assert [r["n"] for r in found] == [2, 0, 1] and found[1]["ci_lo"] is None
    assert 1 <= found[0]["ci_lo"] <= 2 <= found[0]["ci_hi"] <= 3 and found[2]["ci_hi"] == 5.0
    with pytest.raises(ValueError):
        buckets.aggregate_signals(features, "1h", method="exact")


@pytest.mark.parametrize("n", [1, 16, 17, 1000])
def test_a_walk_draws_every_node_once(n, monkeypatch):
    nodes, plain_draw = [], resampling.binomials
    monkeypatch.setattr(resampling, "binomials", lambda draws, share, node: nodes.append(node) or plain_draw(draws, share, node))
    blocks = -(-n // 16)
    tree = resampling.Tree("g", n, 16, 30)
    walked = [tree.draws(at).tolist() for at in range(blocks)]
    assert len(nodes) == len(set(nodes)) == blocks - 1
    assert walked == [resampling.block_draws("g", n, at, 16, 30).tolist() for at in range(blocks)]


def test_sums_do_not_depend_on_batches_or_stretches(spark, monkeypatch):
    df = spark.range(700).selectExpr("if(id % 3 = 0, null, id % 2) as g", "id as k", "sin(id) as _x").repartition(5)
    placed = resampling.placed_rows(df, ["g"], ["k"]).persist()

    def sums():
        return {(r["g"], r["_b"]): (r["_w"], round(r["_wx"], 9)) for r in resampling.replicate_sums(placed, ["g"], 10, 16).collect()}

    whole = sums()
    monkeypatch.setattr(resampling, "STRETCH", 32)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        assert sums() == whole and len(whole) == 30
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
        placed.unpersist()
