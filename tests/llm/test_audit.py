import re
from collections import Counter
from itertools import permutations

from conftest import prose

from tidemark.llm import filter_audit

COLUMNS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def plain_fails(text, doc_id, smallest):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return {c for c, failed in (
        ("A", len(words) < 200), ("B", 100 * len(set(words)) < 50 * len(words)),
        ("C", 100 * len(re.findall("[A-Z]", text)) > 3 * len(text)), ("D", bool(re.search("[#$%&*|]", text))),
        ("E", doc_id is not None and smallest.get(text, doc_id) < doc_id),
    ) if failed}


def plain_audit(rows, labels):
    good, toxic = ({i for i, q, t in labels if i is not None and (q, t)[k] == 1} for k in (0, 1))
    smallest = {}
    for doc_id, text, _ in rows:
        if doc_id is not None:
            smallest[text or ""] = min(doc_id, smallest.get(text or "", doc_id))
    by_part = {}
    for doc_id, text, lang in rows:
        by_part.setdefault(lang or "", []).append((doc_id, plain_fails(text or "", doc_id, smallest)))
    out, shapley = [], Counter()
    for part, docs in by_part.items():
        for order in permutations("ABCDE"):
            left = list(docs)
            for step, own in enumerate(order, 1):
                gone = [d for d in left if own in d[1]]
                left = [d for d in left if own not in d[1]]
                failing = [d for d in docs if own in d[1]]
                shapley[part, own] += len(gone)
                out.append([
                    part, "".join(order), step, len(left), len(gone), len(failing) - len(gone), sum(d[1] == {own} for d in docs),
                    sum(d[0] in good for d in gone), sum(d[0] in toxic for d in gone),
                ])
    return [(*r, shapley[r[0], r[1][r[2] - 1]]) for r in out]


def table_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


LABELS = [(1, 1, 0), (2, 1, 1), (2, 0, 0), (3, None, 1), (4, 1, 0), (None, 1, 1), (8, 0, 1), (9, 1, 0), (15, 1, 0), (99, 1, 1), (1, 1, 0)]


def test_equals_brute_force(spark, odd, odd_rows, same_rows):
    labels = table_of(spark, LABELS)
    found = filter_audit.audit(odd, labels)
    assert sorted(found.columns) == sorted(COLUMNS)
    same_rows(found, plain_audit([(r[0], r[1], r[2]) for r in odd_rows], LABELS), *COLUMNS)


def test_large_groups_of_copies_are_salted(spark, monkeypatch, same_rows):
    monkeypatch.setattr(filter_audit, "LEAST_GROUP", 16)
    monkeypatch.setattr(filter_audit, "HOT", 10)
    rows = [(i // 2, "the same text", "en") for i in range(900)] + [(None, "the same text", None)] * 50
    rows += [(5000 + i, prose(i % 30, 210), "de" if i % 3 else "") for i in range(120)] + [(7000, None, "de"), (7001, "", "de")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    same_rows(filter_audit.audit(docs, table_of(spark, [])), plain_audit(rows, []), *COLUMNS)


def test_each_repeat_meets_one_row(spark):
    """A copy meets the least row of its text, not all others."""
    docs = spark.createDataFrame([(i, "same") for i in range(3000)], "id long, text string").selectExpr("id", "xxhash64(text) tag", "text")
    found = filter_audit.copies(docs)
    assert found.count() == 2999
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan and "Cross" not in plan


def test_other_filters_by_letter(spark, odd, same_rows):
    from pyspark.sql import functions as F

    counted = filter_audit.combinations(odd, table_of(spark, []), {"X": F.col("text") == "", "Y": F.length("text") > 1000}, "Z")
    found = filter_audit.orders(counted, "XYZ")
    assert {r["filter_order"] for r in found.collect()} == {"".join(p) for p in permutations("XYZ")}
    totals = found.where("part = 'en' and step = 3").select((F.col("kept") + F.col("removed")).alias("n")).distinct().count()
    assert totals > 1
    walked = found.groupBy("part", "filter_order").agg(F.sum("removed").alias("gone"), F.min("kept").alias("left"))
    assert walked.select("part", (F.col("gone") + F.col("left")).alias("n")).distinct().count() == odd.selectExpr("coalesce(lang, '')").distinct().count()


def test_empty_table(spark, empty):
    assert filter_audit.audit(empty, table_of(spark, LABELS)).count() == 0
