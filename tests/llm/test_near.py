import random
import time

import brute
import numpy as np
import pytest
from conftest import prose

from tidemark.llm import near_dup
from tidemark.llm.common import table


def check(docs, rows):
    found = near_dup.near_duplicates(docs)
    got = sorted((tuple(r) for r in found.select("id", "n_shingles", "component_id", "kept").collect()), key=repr)
    expected = brute.near([(i, None if t is None else t.encode()) for i, t, *_ in rows])
    assert got == sorted(((i, n, c, i == c) for (i, *_), (n, c) in zip(rows, expected, strict=True)), key=repr)


def test_odd_rows(odd, odd_rows):
    # an empty set is its own component, also without an id
    check(odd, odd_rows)


def test_chains_of_copies(spark):
    """Each text is near the next one only, so components are long paths."""
    rng = random.Random(6)
    words = [f"w{rng.randrange(10**6)}" for _ in range(200)]
    rows = []
    for i in range(40):
        rows.append((1000 - i, " ".join(words)))
        for _ in range(4):
            words[rng.randrange(200)] = f"w{rng.randrange(10**6)}"
    rows += [(i, " ".join(f"u{rng.randrange(10**6)}" for _ in range(60))) for i in range(30)]
    check(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), rows)


@pytest.mark.parametrize("block", [near_dup.BLOCK, 2])
def test_families_below_the_threshold(spark, monkeypatch, block):
    """Many texts share a passage but few are near; blocks of a list meet each other."""
    monkeypatch.setattr(near_dup, "BLOCK", block)
    rng = random.Random(7)
    passage = [f"p{rng.randrange(10**6)}" for _ in range(80)]
    rows = []
    for i in range(40):
        own = [f"o{rng.randrange(10**6)}" for _ in range(rng.choice((5, 12, 20, 30, 60)))]
        rows.append((i, " ".join(passage + own)))
    check(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), rows)


def test_driver_table(spark, sf):
    docs = table(spark, sf, "documents")
    check(docs, [tuple(r) for r in docs.select("doc_id", "text").collect()])


def test_empty(empty):
    assert near_dup.near_duplicates(empty).count() == 0


def test_collisions_are_those_of_a_full_count():
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2**60, (12, near_dup.COORDINATES), dtype=np.int64)

    def rows(n):
        out = base[rng.integers(0, len(base), n)].copy()
        changed = rng.random(out.shape) < rng.random((n, 1))
        out[changed] = rng.integers(0, 40, changed.sum())  # common values make long lists
        return out

    x, y = rows(70), rows(90)
    wanted = rng.random((70, 90)) < 0.8
    full = (x[:, None, :] == y[None, :, :]).sum(axis=2) >= near_dup.MATCHES
    found = near_dup.collisions(x, y, wanted)
    assert (found == (full & wanted)).all() and found.any()


def test_null_ids_meet_their_own_text_only(spark):
    """3000 rows without an id: texts are found by id and tag, so no pairs of rows arise."""
    texts = [prose(k // 2, 40) + (" more" if k % 2 else "") for k in range(3000)]
    docs = spark.createDataFrame([(None, t) for t in texts], "doc_id long, text string").repartition(4)
    started = time.monotonic()
    found = near_dup.near_duplicates(docs).select("group", "kept").collect()
    assert time.monotonic() - started < 300
    assert len({r["group"] for r in found}) == 1500 and all(r["kept"] for r in found)


def test_families_in_many_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "BLOCK_BYTES", 3000)
    words = prose(21, 60).split()
    texts = [" ".join(words[:k] + [f"x{k}{j}" for j in range(3)] + words[k + 3:]) for k in range(0, 56, 2)]
    rows = list(enumerate(texts))
    check(spark.createDataFrame(rows, "doc_id long, text string"), rows)
