import json
import math
import os

import pytest
from pyspark.sql import functions as F

from tidemark.operators import buckets, clean, features, svd
from tidemark.sources import posts as sources
from tidemark.streaming import live


@pytest.fixture
def arriving(spark, tmp_path):
    rows = [
        ("u%d" % (i % 5), f"2024-01-01T{i % 6:02d}:{i % 60:02d}:00Z", f"{['buy', 'sell', 'hold'][i % 3]} now {i % 20} {'green ' * (i % 4)}", str(i % 4), "s")
        for i in range(300)
    ]
    folder = str(tmp_path / "in")
    columns = "username string, timestamp string, content string, likes string, source_file string"
    raw = spark.createDataFrame(rows, columns).withColumn("likes", F.lit("2")).repartition(3)
    raw.write.json(folder)
    return folder, raw.schema


@pytest.mark.parametrize("with_text", [False, True])
def test_stream_equals_batch(spark, tmp_path, arriving, with_text):
    folder, schema = arriving
    batch = clean.drop_incomplete(clean.clean_posts(spark.read.schema(schema).json(folder), order_by=["username"]))
    scored = features.score_reactions(features.score_text(batch))
    weights, model = {"polarity": 0.4, "engagement": 0.3}, None
    if with_text:
        weights["svd_1"] = 0.3
        model = svd.fit_svd(batch, ["source_file", "uid"], "content", 1, 50)
        scored = svd.with_svd(scored, model)
    fit = live.fit_frozen(scored, weights, model)
    expected = buckets.bucket_means(features.composite_signal(scored, weights), "1h")

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(folder)
    signals = live.live_signals(stream, fit, "1h", delay="1 day")
    out = str(tmp_path / "out")
    query = live.write_live(signals, out, str(tmp_path / "progress"), drain=True)
    query.awaitTermination()
    assert query.exception() is None
    found = {r["timestamp"]: (r["signal"], r["n"]) for r in live.latest_signals(spark, out).collect()}
    wanted = {r["timestamp"]: (r["signal"], r["n"]) for r in expected.collect()}
    assert found.keys() == wanted.keys()
    for start, (signal, n) in wanted.items():
        assert found[start][1] == n and found[start][0] == pytest.approx(signal)


def test_stream_of_json_lines(spark, tmp_path, arriving):
    folder, _ = arriving
    fit = live.FrozenFit({"engagement": (0.0, 1.0)}, {"engagement": 1.0})
    stream = sources.stream_posts(spark, folder, files_per_batch=2).drop("source_file").withColumn("source_file", F.lit("s"))
    signals = live.live_signals(stream, fit, "1D", delay="2 days")
    out = str(tmp_path / "out")
    live.write_live(signals, out, str(tmp_path / "progress"), drain=True).awaitTermination()
    (row,) = live.latest_signals(spark, out).collect()
    assert row["n"] == 60 and row["signal"] == pytest.approx(math.log(3))


def test_late_rows_are_counted_and_folders_compacted(spark, tmp_path, arriving):
    folder, schema = arriving
    fit = live.FrozenFit({"engagement": (0.0, 1.0)}, {"engagement": 1.0})
    found = {}
    for delay in ("1 day", "1 second"):
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(folder)
        out = str(tmp_path / delay)
        query = live.write_live(live.live_signals(stream, fit, "1h", delay=delay), out, f"{out}-progress", drain=True)
        query.awaitTermination()
        before = sorted(live.latest_signals(spark, out).collect())
        live.compact(spark, out)
        assert sorted(live.latest_signals(spark, out).collect()) == before
        assert len([n for n in (tmp_path / delay).iterdir() if n.name.startswith("batch=")]) == 1
        found[delay] = (live.late_rows(query), sum(r["n"] for r in before))
    assert found["1 day"] == (0, 60) and found["1 second"][0] > 0


def test_late_rows_of_all_triggers(spark, tmp_path):
    """Also of those that Spark has forgotten: late posts come early, then triggers without any."""
    folder = tmp_path / "in"
    folder.mkdir()
    schema = "username string, timestamp string, content string, likes string, source_file string"
    hours = [10, 11, 1, 2, 20, 21, 22, 23]
    for i, hour in enumerate(hours):
        (folder / f"{i}.json").write_text(json.dumps({
            "username": f"u{i}", "timestamp": f"2024-01-01T{hour:02d}:00:00Z", "content": f"post {i}", "likes": "2", "source_file": "s",
        }) + "\n")
        os.utime(folder / f"{i}.json", (1_700_000_000 + i, 1_700_000_000 + i))
    fit = live.FrozenFit({"engagement": (0.0, 1.0)}, {"engagement": 1.0})
    key = "spark.sql.streaming.numRecentProgressUpdates"
    before = spark.conf.get(key)
    spark.conf.set(key, "2")
    try:
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(str(folder))
        out = str(tmp_path / "out")
        query = live.write_live(live.live_signals(stream, fit, "1h", delay="1 hour"), out, f"{out}-progress", drain=True)
        query.awaitTermination()
    finally:
        spark.conf.set(key, before)
    kept = sum(r["n"] for r in live.latest_signals(spark, out).collect())
    assert (live.late_rows(query), kept) == (2, 6)


def test_a_weighted_text_part_needs_a_model(spark, arriving):
    folder, schema = arriving
    stream = spark.readStream.schema(schema).json(folder)
    fit = live.FrozenFit({"svd_1": (0.0, 1.0)}, {"svd_1": 1.0})
    with pytest.raises(ValueError):
        live.live_signals(stream, fit)
    with pytest.raises(ValueError):
        live.live_signals(stream, live.FrozenFit({}, {}), "7h")


def test_a_trigger_of_the_live_query_keeps_all_cores_busy(spark, tmp_path, monkeypatch):
    from registry import queries

    ids = spark.range(400)
    ids.selectExpr(
        "id as event_id", "'view' as event_type", "id % 9 as user_id", "cast(id as double) as value",
        "timestamp'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, cast(id as int)) as ts", "'' as props",
    ).write.parquet(str(tmp_path / "events.parquet"))
    ids.limit(0).selectExpr("id as doc_id", "'' as text", "'' as lang", "'' as source", "id as n_chars").write.parquet(str(tmp_path / "documents.parquet"))
    ids.limit(0).selectExpr("id as conv_id", "id as turn", "'' as role", "'' as text").write.parquet(str(tmp_path / "conversations.parquet"))
    parts, run = [], queries.run_folder
    monkeypatch.setattr(queries, "run_folder", lambda s, label: parts.append(run(s, label)) or parts[-1])
    found = queries.QUERIES["live_signal_stream"](spark, str(tmp_path)).collect()
    arriving = next(p for p in parts if "/arriving-" in p)
    assert len([f for f in os.listdir(arriving) if f.endswith(".parquet")]) >= 5 * spark.sparkContext.defaultParallelism
    batches = [f for f in os.listdir(next(p for p in parts if "/live-" in p and "progress" not in p)) if f.startswith("batch=")]
    assert batches and sum(r["n"] for r in found) == sum(1 for i in range(400) if i % 17 not in (2, 3)) and {r["late_rows"] for r in found} == {0}
