import hashlib

import brute
import pytest

import corpus_pipeline as pipeline


@pytest.fixture(scope="module")
def docs(odd):
    return odd.select("doc_id", "text", "lang", "source", "n_chars")


def ids(df):
    return sorted((r[0] for r in df.select("doc_id").collect()), key=repr)


def test_language_stage_keeps_documents_with_letters(spark, docs, sf):
    kept = pipeline.keep_known_languages(spark, docs, sf)
    assert kept.columns == docs.columns
    assert set(ids(kept)) >= {1, 2, 3, 4, 13, 14, 15} and not {5, 6, 7, -3} & set(ids(kept))


def test_near_copy_stage_keeps_one_of_each_group(spark, docs, odd_rows, sf):
    kept = pipeline.keep_one_of_near_copies(spark, docs, sf)
    assert kept.columns == docs.columns
    found = brute.near([(i, None if t is None else t.encode()) for i, t, *_ in odd_rows])
    expected = {(i, t) for (i, t, *_), (_, c) in zip(odd_rows, found, strict=True) if i == c}
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=repr) == sorted(expected, key=repr)


def test_near_copies_with_one_id(spark, sf):
    base = " ".join(f"w{i}" for i in range(90))
    rows = [(1, base), (1, base + " more"), (1, "other words entirely here now"), (2, base), (None, "x y z"), (None, "p q r"), (None, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = sorted(((r["doc_id"], r["text"]) for r in pipeline.keep_one_of_near_copies(spark, docs, sf).collect()), key=repr)
    assert [k for k in kept if k[0] is None] == [(None, "p q r"), (None, "x y z"), (None, None)]
    assert len([k for k in kept if k[0] == 1]) == 2 and not [k for k in kept if k[0] == 2]


def test_passage_stage_cuts_bytes(spark, docs, odd_rows, sf):
    cut = {(r["doc_id"], r["text"]): r["n_chars"] for r in pipeline.cut_repeated_passages(spark, docs, sf).collect()}
    left = brute.repeats([(t or "").encode() for _, t, *_ in odd_rows], 400)
    expected = {
        (i, t if not removed else kept.decode(errors="ignore"))
        for (i, t, *_), (_, removed, _, kept) in zip(odd_rows, left, strict=True) if kept or not removed
    }
    assert set(cut) == expected
    assert all(n == (None if text is None else len(text)) for (_, text), n in cut.items())


def test_passage_stage_cuts_over_50_words(spark, sf):
    """However few bytes they have, also across line breaks; 50 words stay."""
    natural = " ".join(f"word{i}" for i in range(51))
    tiny, fifty = " ".join("abcdefghijklmnopq" * 3), " ".join(map(str, range(50)))
    assert len(natural.split()) == len(tiny.split()) == 51 and len(tiny) < 200 < len(natural) < 400
    around = [" ".join(f"text{i}-{k}" for k in range(30)) for i in range(12)]
    inner = [natural, natural, tiny, tiny.replace(" ", "\n"), fifty, fifty]
    rows = [(i, f"{around[2 * i]} {p} {around[2 * i + 1]}", "en", "s", 1) for i, p in enumerate(inner)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    cut = dict(pipeline.cut_repeated_passages(spark, docs, sf).select("doc_id", "text").collect())
    assert cut == {i: text if i > 3 else text.replace(inner[i], "") for i, text, *_ in rows}


def test_passage_stage_keeps_replacement_characters(spark, sf):
    """Cuts fall inside é and è, which share their first byte, and à and 丠, which share their last."""
    shared = " ".join(f"word{i}" for i in range(80))
    texts = [f"one \ufffd à{shared}é two \ufffd", f"three 丠{shared}è \ufffd\ufffd four"]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    cut = dict(pipeline.cut_repeated_passages(spark, docs, sf).select("doc_id", "text").collect())
    assert cut == {0: "one \ufffd  two \ufffd", 1: "three  \ufffd\ufffd four"}


def test_last_stages(spark, docs, sf):
    mixed = pipeline.mix_sources(spark, docs, sf)
    assert mixed.columns == docs.columns and set(ids(mixed)) <= set(ids(docs))
    for row in pipeline.encode_texts(spark, docs, sf).collect():
        assert row["decoded_sha256"] == row["text_sha256"] and len(row["ids"]) == 4 * row["n_tokens"]


def test_whole_run(spark, sf):
    done = pipeline.run(spark, sf).collect()
    assert done and all(r["decoded_sha256"] == r["text_sha256"] for r in done)
    assert hashlib.sha256(b"").hexdigest() not in {r["text_sha256"] for r in done}
    assert [name for name, _ in pipeline.STAGES] == ["language", "near_copies", "repeated_passages", "mix", "tokens"]


def test_empty(spark, empty, sf):
    docs = empty.select("doc_id", "text", "lang", "source", "n_chars")
    for _, stage in pipeline.STAGES:
        assert stage(spark, docs, sf).count() == 0


def test_columns_of_any_name_pass_unchanged(spark, odd, sf):
    """Names that operators and stages use themselves."""
    own = [c for c in odd.columns if c not in ("text", "n_chars")]
    before = {repr(r) for r in odd.select(*own).collect()}
    docs = odd
    for name, stage in pipeline.STAGES[:-1]:
        done = stage(spark, docs, sf)
        assert done.columns == odd.columns, name
        after = [repr(r) for r in done.select(*own).collect()]
        assert after and set(after) <= before, name
    assert pipeline.encode_texts(spark, docs, sf).count() == odd.count()
