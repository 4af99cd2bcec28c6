import json
import os

import pytest
from pyspark.sql import functions as F

from registry.queries import QUERIES
from tidemark.operators import clean
from tidemark.plans.features import run_features
from tidemark.plans.display import display_series
from tidemark.plans.ingest import ingest, read_clean
from tidemark.sources import html, posts as sources, tables


def write(folder, name, text):
    with open(os.path.join(folder, name), "w", encoding="utf-8", newline="") as file:
        file.write(text)


POST = {"username": "ann", "timestamp": "2024-01-01T00:00:00Z", "content": "Buy\nnow", "likes": 3}


@pytest.fixture
def dumps(tmp_path):
    folder = str(tmp_path / "in")
    os.makedirs(os.path.join(folder, "below"))
    lines = [POST, {**POST, "username": "bob", "likes": 2.7, "mentions": ["A", "b c"]}, {**POST, "likes": "9", "place": "x", "source_file": "liar"}]
    write(folder, "a_lines.json", "\n".join(json.dumps(p) for p in lines) + "\n")
    write(folder, "b_array.json", json.dumps([{**POST, "username": "cat"}, {**POST, "username": "dan"}], indent=2))
    write(folder, "c_object.json", json.dumps({**POST, "username": "eve", "hashtags": "#q, w"}, indent=2))
    write(folder, "d_flat_array.json", json.dumps([{**POST, "username": "flo"}, {**POST, "username": "gus"}]))
    write(folder, "e_one_line.json", json.dumps({**POST, "username": "hal"}))
    write(folder, "f.csv", 'username,content,likes,score\nivy,"two\nlines, ""quoted""",7.0,1\njon,x,,2\n')
    write(folder, "g.csv", "likes,username,content\n4,kim,NA\n")
    write(folder, "h_empty.json", "\n")
    write(folder, "notes.txt", "not a dump")
    write(os.path.join(folder, "below"), "deep.json", json.dumps(POST))
    return folder


def test_discovery(spark, dumps):
    found = [(r["name"], r["suffix"]) for r in sources.discover_files(spark, dumps).collect()]
    assert [n for n, _ in found] == [
        "a_lines.json", "b_array.json", "c_object.json", "d_flat_array.json", "e_one_line.json", "f.csv", "g.csv",
        "h_empty.json",
    ]
    assert {s for _, s in found} == {".json", ".csv"}


@pytest.mark.parametrize("extras", [None, "place string"])
def test_every_layout(spark, dumps, extras):
    posts = clean.clean_posts(sources.read_posts(spark, dumps, extras=extras))
    rows = {(r["source_file"], r["username"]): r for r in posts.collect()}
    assert len(rows) == 11
    assert rows["a_lines.json", "ann"]["likes"] == 3  # the first of two copies
    assert rows["a_lines.json", "bob"]["likes"] == 2
    assert rows["a_lines.json", "bob"]["_mentions_list"] == ["a", "b c"]
    assert rows["a_lines.json", "ann"]["content"] == "Buy now"
    assert rows["c_object.json", "eve"]["_hashtags_list"] == ["#q", "w"]
    assert {u for f, u in rows if f == "b_array.json"} == {"cat", "dan"}
    assert {u for f, u in rows if f == "d_flat_array.json"} == {"flo", "gus"}
    assert rows["f.csv", "ivy"]["content"] == 'two lines, "quoted"' and rows["f.csv", "ivy"]["likes"] == 7
    assert rows["f.csv", "jon"]["likes"] == 0 and rows["f.csv", "jon"]["score"] == "2"
    assert rows["g.csv", "kim"]["content"] == "" and rows["g.csv", "kim"]["likes"] == 4
    assert "place" in posts.columns and "_file_order" not in posts.columns


GOOD = [json.dumps({**POST, "username": name}) for name in ("ann", "bob", "cat", "dan", "eve")]
BROKEN = {
    "first_line": "\n".join(['{"username": "cut', *GOOD]),
    "comment": "\n".join(["# exported", *GOOD]),
    "middle_line": "\n".join([*GOOD[:2], '{"username": "cut', *GOOD[2:]]),
    "cut_array": "[\n" + ",\n".join(GOOD),
    "bad_item": "[\n" + ",\n".join([*GOOD, '{"username": }']) + "\n]",
    "cut_object": '{"username": "ann",\n"content": "x"',
}


@pytest.mark.parametrize("kind", BROKEN)
def test_broken_json_is_an_error_that_names_the_file(spark, tmp_path, kind):
    write(str(tmp_path), "fine.json", GOOD[0] + "\n")
    write(str(tmp_path), f"{kind}.json", BROKEN[kind])
    with pytest.raises(Exception, match=f"{kind}.json"):
        sources.read_posts(spark, str(tmp_path), extras="").collect()


@pytest.mark.parametrize("kind", BROKEN)
def test_broken_json_can_be_set_aside(spark, tmp_path, kind):
    write(str(tmp_path), "fine.json", json.dumps({**POST, "username": "zoe"}) + "\n")
    write(str(tmp_path), f"{kind}.json", BROKEN[kind])
    rows = sources.read_posts(spark, str(tmp_path), extras="", broken="skip").collect()
    names = sorted(r["username"] for r in rows)
    if kind in ("first_line", "comment", "middle_line"):
        assert names == ["ann", "bob", "cat", "dan", "eve", "zoe"]
    else:
        assert "zoe" in names and all(names)  # never a blank post
    aside = sources.broken_records(spark, str(tmp_path)).collect()
    assert aside and all(r["path"].endswith(f"{kind}.json") and r["record"] for r in aside)


NESTED = {
    "pairs": '[\n{"username": "ann", "content": "x", "pairs": [\n[1, 2],\n[3, 4]\n]},\n{"username": "bob", "content": "y"}\n]',
    "object": '{\n"username": "cat",\n"content": "z",\n"more": [\n{"k": 1}\n]\n}',
}


@pytest.mark.parametrize("broken", ["fail", "skip"])
def test_nested_values_alone_on_a_line(spark, tmp_path, broken):
    for name, text in NESTED.items():
        write(str(tmp_path), f"{name}.json", text)
    rows = sources.read_posts(spark, str(tmp_path), extras="", broken=broken).collect()
    assert sorted(r["username"] for r in rows) == ["ann", "bob", "cat"]
    assert sources.broken_records(spark, str(tmp_path)).collect() == []


@pytest.mark.parametrize("kind", NESTED)
def test_lines_of_a_broken_document_are_no_posts(spark, tmp_path, kind):
    write(str(tmp_path), f"{kind}.json", NESTED[kind][:-2])
    assert sources.read_posts(spark, str(tmp_path), extras="", broken="skip").collect() == []
    (aside,) = sources.broken_records(spark, str(tmp_path)).collect()
    assert aside["path"].endswith(f"{kind}.json") and aside["record"] == NESTED[kind][:-2]


def test_odd_file_names(spark, tmp_path):
    names = ["a b.json", "c+d.json", "e%41.json", "#x y.json", "f[1].json", "\u00e9.json"]
    for name in names:
        write(str(tmp_path), name, json.dumps({**POST, "username": name}) + "\n")
    write(str(tmp_path), "g {2}.csv", "username,content\ng {2}.csv,x\n")
    rows = sources.read_posts(spark, str(tmp_path), "").collect()
    assert sorted(r["source_file"] for r in rows) == sorted([*names, "g {2}.csv"])
    assert all(r["source_file"] == r["username"] for r in rows)
    found = sources.discover_files(spark, str(tmp_path)).collect()
    assert sorted(r["name"] for r in found) == sorted([*names, "g {2}.csv"])


def test_known_layouts_need_no_text_pass(spark, tmp_path):
    write(str(tmp_path), "a.json", json.dumps(POST) + "\n")
    write(str(tmp_path), "b.csv", "username,content\nbob,x\n")
    write(str(tmp_path), "c.csv", "username,content\ncat,y\n")
    found = sources.read_posts(spark, str(tmp_path), "", json_layout="lines", csv_layout="same")
    assert sorted(r["username"] for r in found.collect()) == ["ann", "bob", "cat"]
    with pytest.raises(ValueError):
        sources.read_posts(spark, str(tmp_path), json_layout="pretty")


def test_bad_bytes_do_not_stop_a_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(b"username,content\nann,caf\xe9 ok\nbob,fine\n")
    rows = clean.clean_posts(sources.read_posts(spark, str(tmp_path))).orderBy("username").collect()
    assert [r["username"] for r in rows] == ["ann", "bob"] and rows[0]["content"].endswith("ok")


def test_no_files(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        sources.read_posts(spark, str(tmp_path))


def test_ingest_then_features_then_display(spark, dumps, tmp_path):
    out = str(tmp_path / "out")
    done = ingest(spark, dumps, out).first()
    assert done["rows_written"] == 11 and done["files"] == 8
    per_file = {r["name"]: r["rows"] for r in spark.read.json(f"{out}/ingest_files").collect()}
    assert per_file["a_lines.json"] == 2 and per_file["h_empty.json"] == 0 and len(per_file) == 8
    stored = read_clean(spark, f"{out}/posts")
    assert stored.where("date = '2024-01-01'").count() == 8
    features, signals = run_features(spark, f"{out}/posts", out, "1h")
    scores = spark.read.parquet(features)
    assert scores.columns[:10] == [
        "uid", "timestamp", "username", "hashtag_primary", "_hashtags_list", "polarity", "urgency", "engagement",
        "svd_1", "composite_signal",
    ]
    assert scores.count() == 8  # rows without a time are left out
    series = display_series(tables.read_table(spark, signals))
    assert series.columns == ["timestamp", "signal", "ci_lo", "ci_hi"] and series.count() == 1


def test_partition_filter_prunes(spark, dumps, tmp_path, plan):
    tables.write_posts(clean.clean_posts(sources.read_posts(spark, dumps, extras="place string")), str(tmp_path / "p"))
    text = plan(read_clean(spark, str(tmp_path / "p")).where("date = '2024-01-01'").select("uid"))
    assert "PartitionFilters: [(cast(date" in text or "PartitionFilters: [isnotnull" in text
    scan = plan(tables.load_minimal(spark, str(tmp_path / "p")))
    schema = scan[scan.index("ReadSchema"):]
    assert "scraped_at" not in schema and "_mentions_list" not in schema and "content" in schema


def test_csv_and_stats_by_hashtag(spark, tmp_path):
    rows = spark.createDataFrame([("x", 'a "b"\nc', ["p", "q"]), ("y/z", "d", [])], "hashtag string, content string, l array<string>")
    tables.write_csv_by_hashtag(rows, str(tmp_path / "csv"))
    back = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(str(tmp_path / "csv"))
    assert sorted((r["hashtag"], r["content"], r["l"]) for r in back.collect()) == [
        ("x", 'a "b"\nc', "p, q"), ("y/z", "d", None),
    ]


PAGE = """
<html><script>var x = "<a href='/no'>";</script><body>
<article data-testid="tweet">
  <a href="/ann">Ann</a> <a href="/ann"><span>@ann</span></a> <time datetime="2024-01-01T00:00:00.000Z">now</time>
  <div data-testid="tweetText"> Buy &amp; <b>hold</b> <a href="/hashtag/nifty?src=x">#nifty</a> a < b </div>
  <a href="https://t.co/x">t</a><a href="https://twitter.com/y">y</a><img src="i"><a href="/status/1/2">z</a>
  <div data-testid="reply"><span>12</span></div><div data-testid="retweet">1.5K</div><div data-testid="like"></div>
</article>
<article data-testid="tweet"><div data-testid="tweetText">no author</div></article>
<article data-testid="tweet"><a href="/bob">x</a></article>
<article data-testid="tweet"><a href="/cat">x</a><div data-testid="tweetText">no time
</article></body></html>"""


def test_posts_from_a_page(spark):
    pages = spark.createDataFrame([(1, PAGE), (2, ""), (3, None), (4, "<p>plain</p>")], "page_id int, html string")
    first, second = html.extract_posts(pages).orderBy("page_post").collect()
    assert (first["username"], first["timestamp"]) == ("ann", "2024-01-01T00:00:00.000Z")
    assert first["content"] == "Buy &hold#niftya < b"
    assert (first["replies"], first["retweets"], first["likes"]) == (12, 1500, 0)
    assert (first["mentions"], first["hashtags"], first["urls"]) == ("@ann", "#nifty", "https://t.co/x")
    assert (second["username"], second["content"], second["timestamp"], second["replies"]) == ("cat", "no time", None, 0)


def test_extracted_posts_can_be_cleaned(spark):
    pages = spark.createDataFrame([(1, PAGE)], "page_id int, html string")
    posts = clean.clean_posts(html.extract_posts(pages), order_by=["page_post"])
    row = posts.where(F.col("username") == "ann").first()
    assert row["_hashtags_list"] == ["#nifty", "#niftya"] and row["retweets"] == 1500 and row["date"] == "2024-01-01"


def test_lines_with_a_broken_one_are_never_read_whole(spark, tmp_path, monkeypatch):
    good = [f'{{"username": "u{i}", "content": "x", "nested": {{"a": [1]}}}}' for i in range(5)]
    write(str(tmp_path), "a.json", "\n".join([*good[:3], '{"username": "cut', *good[3:]]) + "\n")
    write(str(tmp_path), "b.json", "\n".join([good[0], "}", good[1]]))
    monkeypatch.setattr(sources, "_whole_files", lambda *a: pytest.fail("read as one text"))
    layouts = {r["path"].rsplit("/")[-1]: r["layout"] for r in sources.json_layouts(spark, str(tmp_path)).collect()}
    assert layouts == {"a.json": "broken", "b.json": "broken"}
    with pytest.raises(ValueError, match="a.json"):
        sources.read_posts(spark, str(tmp_path), "")
    found = sources.read_posts(spark, str(tmp_path), "", broken="skip")
    assert sorted(r["username"] for r in found.select("username").collect()) == ["u0", "u0", "u1", "u1", "u2", "u3", "u4"]


def test_numbers_of_csv_posts_are_ordered_as_numbers(spark, tmp_path):
    """Two posts with one uid: the first by number is kept, though as text 4329 comes before 9."""
    text = "alike"
    tables = {
        "documents": ([(i, text, "xx", "src", i) for i in (9, 4329)], "doc_id long, text string, lang string, source string, n_chars long"),
        "events": ([], "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"),
        "conversations": ([], "conv_id long, turn long, role string, text string"),
    }
    for name, (rows, kinds) in tables.items():
        spark.createDataFrame(rows, kinds).coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    found = {name: [r["post_no"] for r in QUERIES[name](spark, str(tmp_path)).collect()] for name in ("csv_source", "json_lines_source")}
    assert found == {"csv_source": [9], "json_lines_source": [9]}


def test_a_scan_is_dealt_out_by_rows_and_bytes(spark, tmp_path):
    """A small file of many rows must not become as many tasks as there are cores, whatever its rows."""
    from tidemark.session import PARTITION_BYTES, TASK_ROWS, spread, stored_bytes

    spark.range(8 * TASK_ROWS + 1).coalesce(1).write.parquet(f"{tmp_path}/rows.parquet")
    scan = spark.read.parquet(f"{tmp_path}/rows.parquet")
    sizes = [r["count"] for r in spread(scan).groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 8 * TASK_ROWS + 1 and max(sizes) <= 1.05 * TASK_ROWS
    assert spread(scan, 20 * PARTITION_BYTES).rdd.getNumPartitions() == 20
    assert 0 < stored_bytes(spark, f"{tmp_path}/rows.parquet") < 20 * PARTITION_BYTES


def test_layouts_are_judged_without_sorting_lines(spark, tmp_path, plan):
    texts = {
        "bom.json": "\ufeff{\"content\": \"a\"}  \n\n  {\"content\": \"b\"}\t \n",
        "end.json": "{\"content\": \"a\"} \u2028\n[1, 2]\u0085\n",
        "odd.json": "\u015b\n{\"content\": \"a\"}\n\u015d\n",
        "array.json": "[\n {\"content\": \"a\", \"tags\": [\n\"x\"\n]},\n{\"content\": \"b\"}\n] \n",
        "torn.json": "[{\"content\": \"a\"},\n{\"content\": \"b\"},\n",
        "one.json": "{\n \"content\": \"a\"\n}",
    }
    for name, text in texts.items():
        (tmp_path / name).write_text(text, encoding="utf-8")
    found = {r["path"].rsplit("/")[-1]: r["layout"] for r in sources.json_layouts(spark, str(tmp_path)).collect()}
    assert found == {
        "bom.json": "lines", "end.json": "broken", "odd.json": "broken", "array.json": "document", "torn.json": "broken_document", "one.json": "document",
    }
    assert "SortAggregate" not in plan(sources._told_by_lines(spark, str(tmp_path)))
