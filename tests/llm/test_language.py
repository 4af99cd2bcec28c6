import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import langid
from tidemark.llm.common import table


def test_held_out_accuracy(spark, sf):
    docs = table(spark, sf, "documents")
    held = langid.held_out(F.col("doc_id"))
    model = langid.fit(docs.where(~held))
    told = docs.where(held).select("lang", langid.predict(F.col("text"), model).alias("p")).collect()
    assert np.mean([r["lang"] == r["p"]["lang_pred"] for r in told]) > 0.9
    assert all(0 <= r["p"]["score"] <= 1 for r in told)


def test_odd_rows(odd, empty):
    model = langid.fit(odd)
    told = {r["doc_id"]: r["p"] for r in odd.select("doc_id", langid.predict(F.col("text"), model).alias("p")).collect()}
    assert all(told[i]["lang_pred"] == "und" for i in (5, 6, 7, -3)) and told[18]["lang_pred"] == "ja"
    assert set(model.languages) == {"en", "fr", "ja"}  # "de" has no letters to learn from
    nothing = langid.fit(empty)
    assert nothing.languages == () and langid.classify("text", nothing) == ("und", 0.0)


def test_fallback_beyond_the_cap(spark):
    """Both languages fill their filters; the one with more training n-grams sorts last."""
    rows = [(1, "one two three four", "aa"), (2, "five six seven eight nine ten eleven twelve", "zz")]
    model = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), grams_per_language=5)
    assert model.languages == ("aa", "zz") and langid.classify("日本", model) == ("zz", 0.0)


def test_filters_against_sets():
    """Answers agree with exact sets but for the false positives that the correction expects."""
    rng = np.random.default_rng(1)
    frequent = {name: np.unique(rng.integers(0, 2**63, 3000).astype(np.uint64)) for name in (f"l{i:03}" for i in range(70))}
    model = langid.build_filters(frequent, 1 << 14, 3)
    assert model.cells.shape[0] == 2  # more than 64 languages take a second plane
    for k in (0, 69):
        own = frequent[model.languages[k]]
        inside = np.full(len(own), ~np.uint64(0))
        for places in langid._slots(own, 1 << 14, 3):
            inside &= model.cells[k // 64][places]
        assert ((inside >> np.uint64(k % 64)) & np.uint64(1)).all()
    other = rng.integers(0, 2**63, 20000).astype(np.uint64)
    passed = np.full(len(other), ~np.uint64(0))
    for places in langid._slots(other, 1 << 14, 3):
        passed &= model.cells[0][places]
    assert abs(np.mean(passed & np.uint64(1)) - model.false_rates[0]) < 0.02


def test_split_of_documents(spark):
    import zlib

    rows = spark.createDataFrame([(i,) for i in range(50)] + [(None,)], "doc_id long").select("doc_id", langid.held_out(F.col("doc_id")).alias("h")).collect()
    assert all(r["h"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)


def test_classify_equals_plain_sets():
    """Sets of n-grams in place of filters that hardly ever err, and the same correction."""
    rng = np.random.default_rng(3)
    words = {name: ["".join(rng.choice(list(letters), 5)) for _ in range(60)] for name, letters in (("aa", "abcde"), ("bb", "defgh"), ("cc", "ghijk"))}
    learned = {name: " ".join(found) for name, found in words.items()}
    known = {name: set(langid.grams(text).tolist()) for name, text in learned.items()}
    model = langid.build_filters({name: np.array(sorted(codes), dtype=np.uint64) for name, codes in known.items()}, 1 << 20, 4)
    for _ in range(300):
        mixed = [rng.choice(words[rng.choice(("aa", "bb", "cc"))]) for _ in range(rng.integers(1, 12))]
        text = rng.choice((" ", ", ", " 12 ")).join(mixed)
        codes = langid.grams(text).tolist()
        hits = {name: sum(c in found for c in codes) for name, found in known.items()}
        real = {name: (n - len(codes) * rate) / (1 - rate) for (name, n), rate in zip(hits.items(), model.false_rates, strict=True)}
        best = max(sorted(real), key=real.get)
        assert langid.classify(text, model) == (best, min(1.0, real[best] / len(codes)))


def test_learning_moves_no_text(spark, sf, monkeypatch):
    """What is shuffled are counts: the sample is taken in the scan."""
    plans = []
    frame = type(spark.range(1))
    told = frame.mapInArrow
    monkeypatch.setattr(frame, "mapInArrow", lambda self, *a, **b: plans.append(self) or told(self, *a, **b))
    langid.fit(table(spark, sf, "documents"))
    assert len(plans) == 1 and "Exchange" not in plans[0]._jdf.queryExecution().executedPlan().toString()
