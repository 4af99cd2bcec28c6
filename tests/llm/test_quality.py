import brute
import pytest
from pyspark.sql import functions as F

from tidemark.llm import quality_llr

RULES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def test_rules_of_odd_texts(odd, odd_rows, same_rows):
    judged = quality_llr.judge(odd, [0] * 64)
    expected = [(i, *[brute.quality(t)[c] for c in RULES]) for i, t, *_ in odd_rows]
    same_rows(judged, expected, "doc_id", *RULES)
    assert judged.where("base_failed and kept").count() == 0


def test_ratios_from_counts(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "a c"), (3, None)], "doc_id long, text string")
    trusted = spark.createDataFrame([(1,), (1,), (None,)], "doc_id long")
    ratios = quality_llr.fit_ratios(docs, trusted, buckets=32)
    words = quality_llr.word_codes(quality_llr.words(F.col("text")))
    rows = docs.where("text is not null").select(
        "doc_id", F.concat(words, quality_llr.pair_codes(words)).alias("c")
    ).collect()
    import math

    raw, good = [0] * 32, [0] * 32
    for row in rows:
        for code in row["c"]:
            raw[code % 32] += 1
            good[code % 32] += row["doc_id"] == 1
    expected = [
        1e6 * (math.log((g + 1) / (sum(good) + 32)) - math.log((r + 1) / (sum(raw) + 32)))
        for g, r in zip(good, raw, strict=True)
    ]
    assert ratios == pytest.approx(expected, abs=1)


def test_verdict_follows_the_ratio(spark):
    good = " ".join(f"word{i}" for i in range(60))
    bad = " ".join(f"junk{i}" for i in range(60))
    docs = spark.createDataFrame([(i, good) for i in range(6)] + [(9, bad)], "doc_id long, text string")
    trusted = spark.createDataFrame([(i,) for i in range(6)], "doc_id long")
    judged = quality_llr.judge(docs, quality_llr.fit_ratios(docs, trusted))
    assert {r["doc_id"]: r["kept"] for r in judged.collect()} == {**dict.fromkeys(range(6), True), 9: False}


def test_nothing_trusted_and_empty(odd, empty, spark):
    none = spark.createDataFrame([], "doc_id long")
    assert set(quality_llr.fit_ratios(odd, none, buckets=16)) == {0}
    assert set(quality_llr.fit_ratios(empty, none, buckets=16)) == {0}
    assert quality_llr.judge(empty, [0] * 16).count() == 0


def test_main_path_is_native(odd, plan):
    assert "Python" not in plan(quality_llr.judge(odd, [0] * 16))
