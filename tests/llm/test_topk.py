import random

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import topk

NAN, INF = float("nan"), float("inf")


def expected(rows, k):
    fine = [(i, v) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    vectors = [(i, [int(np.floor(256 * float(x))) for x in v]) for i, v in fine]
    out = []
    for q, v in vectors:
        if q % 2:
            continue
        scores = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), i) for i, w in vectors if i != q and len(w) == len(v))
        out += [(q, rank, i, -s) for rank, (s, i) in enumerate(scores[:k], 1)]
    return out


@pytest.mark.parametrize("blocks", [(512, 4096), (3, 7)])
def test_ties_nulls_and_blocks(spark, same_rows, blocks):
    rng = random.Random(3)
    rows = [(i, [rng.choice((-1.0, 0.0, 0.5, 1.0)) for _ in range(6)]) for i in range(60)]
    rows += [(60, None), (61, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (62, [NAN] * 6), (63, [INF] * 6), (None, [1.0] * 6), (64, []), (66, [1.0, 2.0]), (68, [1.0, 3.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 as id", "2 as q", "3 as v", "4 as dim")
    found = topk.top_k(df, F.col("vec_id") % 2 == 0, query_block=blocks[0], vector_block=blocks[1])
    same_rows(found, expected(rows, 5), "query_id", "rank", "vec_id", "score")


def test_few_and_none(spark, same_rows):
    rows = [(0, [1.0, 2.0]), (2, [3.0, -1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    same_rows(topk.top_k(df, F.col("vec_id") % 2 == 0), expected(rows, 5), "query_id", "rank", "vec_id", "score")
    assert topk.top_k(df.limit(0), F.col("vec_id") % 2 == 0).count() == 0


def test_huge_components(spark, same_rows):
    rows = [(0, [1e6, 2e6]), (2, [3e6, -1e6]), (4, [1e6 + 1, 5.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    same_rows(topk.top_k(df, F.col("vec_id") % 2 == 0), expected(rows, 5), "query_id", "rank", "vec_id", "score")


def test_repeated_and_different_vectors_of_one_id(spark):
    rows = [(0, [1.0, 0.0])] * 3 + [(0, [0.0, 1.0]), (1, [2.0, 1.0]), (1, [2.0, 1.0]), (3, [1.0, 3.0]), (5, [0.0, 4.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = topk.top_k(df, F.col("vec_id") == 0, k=2, query_block=1, vector_block=2)
    got = sorted(tuple(r) for r in found.select("query_id", "rank", "vec_id", "score").collect())
    one, two = 256 * 256, 2 * 256 * 256
    # (1, 0) prefers 1 and 3, (0, 1) prefers 5 and 3; the third (1, 0) adds nothing
    assert got == sorted([(0, 1, 1, two), (0, 2, 3, one), (0, 1, 5, 4 * one), (0, 2, 3, 3 * one)])


def test_bounds_close_where_few_dimensions_decide(monkeypatch):
    """Queries stop before the lists end, and what they left unread is never resolved."""
    rng = np.random.default_rng(6)
    vectors = rng.integers(-3, 4, (2000, 16)).astype(float)
    vectors[:, 0] = rng.permutation(2000)
    queries, depths = np.tile(vectors[:1], (4, 1)), []
    queries[:, 0] = [900, 1200, -700, 1500]
    partition = np.partition
    monkeypatch.setattr(topk.np, "partition", lambda lower, *a, **b: depths.append(len(lower)) or partition(lower, *a, **b))
    found = topk.read_block(queries, np.full(4, -1), vectors, np.arange(2000), 5, np.full(4, -np.inf))
    assert depths == [4]  # one look, at the first depth
    for query, (scores, ids) in zip(queries, found, strict=True):
        exact = vectors @ query
        assert scores.tolist() == sorted(exact, reverse=True)[:5] and (exact[ids] == scores).all()


def test_bounds_stop_early():
    """One cluster holds the best; the rest is never resolved."""
    rng = np.random.default_rng(5)
    vectors = np.concatenate([rng.integers(-20, 20, (3000, 8)), rng.integers(200, 256, (40, 8))]).astype(float)
    queries, ids = vectors[-3:], np.arange(3040)
    found = topk.read_block(queries, ids[-3:], vectors, ids, 5, np.full(3, -np.inf))
    plain = brute.top_k(dict(zip(ids.tolist(), vectors.astype(int).tolist(), strict=True)), [3037, 3038, 3039], 5)
    got = [(q, r, int(i), int(s)) for q, (scores, names) in zip((3037, 3038, 3039), found, strict=True) for r, (s, i) in enumerate(zip(scores, names, strict=True), 1)]
    assert got == plain


def test_vectors_are_written_once_however_many_queries(spark, same_rows, monkeypatch):
    """Joined to each block of queries, vectors would be copied once for each; only names of blocks and results are."""
    rng = random.Random(8)
    rows = [(i, [rng.choice((-1.0, 0.0, 0.5, 1.0)) for _ in range(6)]) for i in range(90)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    monkeypatch.setattr(topk, "GROUP_BLOCKS", 2)
    found = topk.top_k(df, F.col("vec_id") % 2 == 0, query_block=3, vector_block=7)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" in plan and "_rows" not in plan and "embedding" not in plan
    same_rows(found, expected(rows, 5), "query_id", "rank", "vec_id", "score")


def test_blocks_add_up_to_one_search():
    """Scores of earlier blocks leave out only what can't be among the best, whatever kind of numbers a block needs."""
    rng = np.random.default_rng(9)
    vectors = rng.integers(-200, 200, (900, 8))
    vectors[300:600] *= 2**17  # these need doubles
    vectors[450] = vectors[451]
    ids, queries = np.arange(900), np.concatenate([vectors[:50], vectors[440:460]])
    names = np.concatenate([np.arange(50), np.arange(440, 460)])
    asked = topk._Asked(names, names, queries, 5)
    for i in range(0, 900, 90):
        asked.add(topk._Held(ids[i : i + 90], vectors[i : i + 90]))
    plain = brute.top_k(dict(zip(ids.tolist(), vectors.tolist(), strict=True)), names.tolist(), 5)
    got = asked.told().to_pydict()
    assert list(zip(got["query_id"], got["vec_id"], got["score"], strict=True)) == [(q, i, s) for q, _, i, s in plain]
