import random
import time
from collections import Counter

import brute
import numpy as np
import pytest
from conftest import prose

from tidemark.llm import suffix_dedup


def check(df, rows, length):
    expected = [(i, *r) for (i, *_), r in zip(rows, brute.repeats([(t or "").encode() for _, t, *_ in rows], length), strict=True)]
    found = [(r[0], r[1], r[2], r[3], bytes(r[4])) for r in df.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept").collect()]
    assert sorted(found, key=repr) == sorted(expected, key=repr)


def test_odd_rows(odd, odd_rows, empty):
    cut = suffix_dedup.drop_repeated(odd)
    assert cut.columns == [
        *[c for c in odd.columns if c not in ("n_bytes", "n_removed", "kept", "kept_text")], "n_bytes", "n_removed", "n_spans", "kept", "kept_text",
    ]
    check(cut, odd_rows, 400)
    assert suffix_dedup.drop_repeated(empty).count() == 0


@pytest.mark.parametrize("group", [4000, 2])
def test_shared_passages(spark, group):
    """Also with every seed counted window by window."""
    rng = random.Random(4)
    base = ["".join(rng.choice("abcde \n") for _ in range(rng.randrange(20, 700))) for _ in range(6)]
    rows = []
    for i in range(40):
        text = list("".join(rng.choice(base) for _ in range(2)))
        for _ in range(rng.randrange(3)):
            text[rng.randrange(len(text))] = rng.choice("XYé")
        rows.append((i, "".join(text)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    check(suffix_dedup.drop_repeated(docs, length=120, group=group), rows, 120)


@pytest.mark.parametrize("group", [4000, 2])
def test_shared_passages_of_words(spark, group):
    """Passages of 12 words beside strings of 120 bytes, against sets of all windows."""
    rng = random.Random(5)
    base = [[rng.choice(["é", "a", "be", "sea", "x" * 9, "y" * 40]) + str(rng.randrange(30)) for _ in range(rng.randrange(5, 40))] for _ in range(8)]
    rows = []
    for i in range(40):
        words = [w for _ in range(2) for w in [f"u{i}{rng.random()}", *rng.choice(base)]]
        for _ in range(rng.randrange(4)):
            words[rng.randrange(len(words))] = "Z" + str(rng.random())
        rows.append((i, "".join(w + rng.choice([" ", " ", " ", "\n", " \t"]) for w in words)))
    texts = [t.encode() for _, t in rows]
    gone = [[False] * len(t) for t in texts]
    single = [[(k, k + 1) for k in range(len(t))] for t in texts]
    spans = [[m.span() for m in brute.WORD.finditer(t)] for t in texts]
    for size, units in ((120, single), (12, spans)):
        windows = [[tuple(t[a:b] for a, b in u[k : k + size]) for k in range(len(u) - size + 1)] for t, u in zip(texts, units, strict=True)]
        times = Counter(w for own in windows for w in own)
        for g, u, own in zip(gone, units, windows, strict=True):
            for k, w in enumerate(own):
                if times[w] > 1:
                    g[u[k][0] : u[k + size - 1][1]] = [True] * (u[k + size - 1][1] - u[k][0])
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = {r[0]: bytes(r[1]) for r in suffix_dedup.drop_repeated(docs, length=120, group=group, words=12).select("doc_id", "kept").collect()}
    assert found == {i: bytes(b for b, x in zip(t, g, strict=True) if not x) for i, (t, g) in enumerate(zip(texts, gone, strict=True))}
    assert found != {r[0]: bytes(r[1]) for r in suffix_dedup.drop_repeated(docs, length=120).select("doc_id", "kept").collect()}


def test_sort_is_a_suffix_sort():
    rng = np.random.default_rng(3)
    data = rng.integers(97, 99, 900).astype(np.uint8)
    sorter = suffix_dedup.SuffixSorter(data, 100)
    suffixes = np.arange(801)
    classes = np.sort(rng.integers(0, 3, 801))
    ordered = sorter.sort(suffixes, classes)
    for c in range(3):
        own = ordered[classes == c].tolist()
        assert own == sorted(suffixes[classes == c].tolist(), key=lambda s: (data[s : s + 100].tobytes(), s))


def test_collisions_fall_back_to_bytes(monkeypatch):
    """With a hash that tells nothing apart, the bytes decide."""
    data = np.frombuffer(b"abcdefgh" * 3 + b"zzzzzzzz", np.uint8)
    sorter = suffix_dedup.SuffixSorter(data, 8)
    monkeypatch.setattr(sorter.hashes, "of", lambda start, size: np.zeros(len(start), dtype=np.uint64))
    suffixes = np.array([0, 8, 16, 24])
    assert sorter.repeated(suffixes, np.zeros(4, dtype=int)).tolist() == [0, 8, 16]


def test_repeated_rows_take_time_in_proportion(spark):
    """Equal rows beside a text that shares a part: each finds the same spans, which count once."""
    own, part = prose(11, 130), prose(12, 70)
    rows = [(1, f"{own} {part}")] * 5000 + [(2, f"{part} {prose(13, 90)}"), (3, prose(14, 90))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    started = time.monotonic()
    found = suffix_dedup.drop_repeated(docs).groupBy("doc_id", "n_removed").count().collect()
    assert time.monotonic() - started < 200
    told = {r["doc_id"]: (r["n_removed"], r["count"]) for r in found}
    assert told[1] == (len(rows[0][1]), 5000) and told[2][0] >= len(part) and told[3] == (0, 1)
