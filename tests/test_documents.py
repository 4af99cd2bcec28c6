import json
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.sources import documents, posts
from test_records import splits  # noqa: F401


def wild_items(seed, n):
    rng = random.Random(seed)
    parts = ["a", '"', "\\", '\\"', "{", "}", "[", "]", "}]", ",", "\n", "é", "漢", " ", "x" * 30]

    def text():
        return "".join(rng.choice(parts) for _ in range(rng.randrange(9)))

    return [{"username": str(i), "content": text(), "more": {"k": [text(), {"z": text()}], text(): {}}, "pairs": [[1, 2], []]} for i in range(n)]


LAYOUTS = [{}, {"indent": 2}, {"indent": 0, "ensure_ascii": False}, {"separators": (",", ":")}]


@pytest.mark.parametrize("size", [900, 1 << 20])
def test_any_split_gives_the_same_items(spark, tmp_path, splits, size):  # noqa: F811
    items = wild_items(1, 12)
    for i, layout in enumerate(LAYOUTS):
        text = json.dumps(items[: 3 * (i + 1)], **layout)
        (tmp_path / f"{i}.json").write_text(("﻿" if i == 2 else "") + text + "\n" * i, encoding="utf-8")
        (tmp_path / f"one_{i}.json").write_text(json.dumps(items[i], **layout) + " " * i, encoding="utf-8")
    (tmp_path / "none.json").write_text(" [\n ] ")
    (tmp_path / "blank.json").write_text("  ")
    splits(size)
    found = documents.document_items(spark, str(tmp_path))
    told = {r["path"].rsplit("/")[-1]: r["sound"] for r in documents.sound_documents(found).collect()}
    assert all(told.values()) or told == {**dict.fromkeys(told, True), "blank.json": False}
    got = {}
    for row in found.where("ends").orderBy("path", "block", "row").collect():
        got.setdefault(row["path"].rsplit("/")[-1], []).append(json.loads(row["item"]))
    expected = {f"{i}.json": items[: 3 * (i + 1)] for i in range(4)} | {f"one_{i}.json": [items[i]] for i in range(4)}
    assert got == expected


BROKEN = {
    "no_end": '[{"a": 1}, {"a": 2}', "no_brace": '{"a": 1', "cut_string": '[{"a": "x}]', "two": '{"a": 1}\n{"a": 2}', "no_comma": '[{"a": 1} {"a": 2}]',
    "two_commas": '[{"a": 1},, {"a": 2}]', "first_comma": '[,{"a": 1}]', "last_comma": '[{"a": 1},]', "number": '[1, {"a": 1}]', "numbers": "[1, 2]",
    "after": '[{"a": 1}] x', "again": '[{"a": 1}][{"a": 2}]', "empty_after": '[{"a": 1}[]', "wrong_bracket": '[{"a": [1}]', "nested": '[[{"a": 1}]]',
    "extra_brace": '{"a": 1}}', "bad_item": '[{"a": 1}, {"a": }]', "one_bracket": "[",
}


@pytest.mark.parametrize("size", [900, 1 << 20])
def test_broken_documents(spark, tmp_path, splits, size):  # noqa: F811
    for name, text in BROKEN.items():
        (tmp_path / f"{name}.json").write_text(text.replace("a", "a" * 700) if size == 900 else text)
    (tmp_path / "fine.json").write_text('[{"a": 1},\n{"a": {"b": "}]"}}]')
    splits(size)
    found = documents.sound_documents(documents.document_items(spark, str(tmp_path))).collect()
    assert {r["path"].rsplit("/")[-1][:-5] for r in found if r["sound"]} == {"fine"} and len(found) == len(BROKEN) + 1


def test_lexing_against_one_character_at_a_time():
    rng = random.Random(5)
    for _ in range(2000):
        pieces = ["".join(rng.choice('[]{"\\a,') for _ in range(rng.randrange(9))) for _ in range(rng.randrange(1, 5))]
        lexed = documents._Lexed(pa.array(["skipped", *pieces]).slice(1))
        for inside in (False, True):
            now, depth, ends = inside, 0, []
            for at, piece in enumerate(pieces):
                slashes = 0
                for c in piece + "}":
                    if c == '"' and slashes % 2 == 0:
                        now = not now
                    elif not now:
                        depth += (c in "[{") - (c in "]}")
                    slashes = slashes + 1 if c == "\\" else 0
                if not now and depth == -1:
                    ends.append(at)
            assert (lexed.change(inside), inside ^ lexed.swaps, lexed.cuts(inside, 0, -1).tolist()) == (depth, now, ends), pieces


@pytest.mark.parametrize("layout", ["auto", "document"])
@pytest.mark.parametrize("extras", [None, "place string"])
def test_one_document_is_read_by_many_tasks(spark, tmp_path, splits, monkeypatch, layout, extras):  # noqa: F811
    items = [{"username": f"u{i}", "content": "x}" * 20, "likes": i, "place": "here"} for i in range(120)]
    (tmp_path / "a.json").write_text(json.dumps(items, indent=1))
    monkeypatch.setattr(posts, "_whole_files", lambda *a: pytest.fail("read as one text"))
    splits(1500)
    (frame,) = posts.read_json(spark, str(tmp_path), layout, extras)
    rows = frame.orderBy("_file_order").selectExpr("username", "cast(likes as int) as likes", "place", "source_file").collect()
    assert [(r["username"], r["likes"], r["place"], r["source_file"]) for r in rows] == [(f"u{i}", i, "here", "a.json") for i in range(120)]
    found = documents.document_items(spark, str(tmp_path))
    assert found.select("block").distinct().count() > 4


def test_forced_layout_and_broken_documents(spark, tmp_path):
    (tmp_path / "fine.json").write_text('[{"username": "ann"}]')
    (tmp_path / "torn.json").write_text('[{"username": "bob"},')
    with pytest.raises(ValueError, match="torn.json"):
        posts.read_json(spark, str(tmp_path), "document", "")
    (frame,) = posts.read_json(spark, str(tmp_path), "document", "", "skip")
    assert [r["username"] for r in frame.collect()] == ["ann"]


def test_too_long_items_are_broken(spark, tmp_path, splits, monkeypatch):  # noqa: F811
    (tmp_path / "a.json").write_text(json.dumps([{"a": "x}" * 1000}, {"a": "y"}]))
    splits(400)
    monkeypatch.setattr(documents, "LONGEST", 900)
    found = documents.document_items(spark, str(tmp_path))
    assert not documents.sound_documents(found).first()["sound"] and found.agg(F.max(F.length("item"))).first()[0] < 900


@pytest.mark.parametrize("size", [900, 1 << 20])
def test_text_of_documents_is_stored_once(spark, tmp_path, splits, monkeypatch, size):  # noqa: F811
    """Pieces and items were two tables with the whole text; only items over the end of a split may be written twice."""
    items, tables, stage = wild_items(4, 60), {}, documents.stage

    def keep(df, label, **options):
        tables[label] = stage(df, label, **options)
        return tables[label]

    monkeypatch.setattr(documents, "stage", keep)
    (tmp_path / "a.json").write_text(json.dumps(items, indent=1))
    splits(size)
    found = documents.document_items(spark, str(tmp_path))
    assert [json.loads(r["item"]) for r in found.where("ends").orderBy("block", "row").collect()] == items
    with_text = {label: table for label, table in tables.items() if "item" in table.columns}
    assert set(with_text) == {"json-items", "json-edges"}
    blocks = found.select("block").distinct().count()
    assert with_text["json-edges"].count() <= blocks + 1 and (size > 900 or blocks > 4)
