import csv
import io
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.sources import posts, records


@pytest.fixture
def splits(spark):
    """Files cut into pieces of a few bytes, one task each."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(n) for n in names]

    def use(size):
        spark.conf.set(names[0], str(size))
        spark.conf.set(names[1], "0")

    yield use
    for name, value in zip(names, before, strict=True):
        spark.conf.set(name, value)


def wild_rows(seed, n):
    rng = random.Random(seed)
    parts = ["a", "b c", '"', '""', ",", "\n", "\n\n", "\r\n", "é", " ", "x" * 30, '",\n"']
    return [["".join(rng.choice(parts) for _ in range(rng.randrange(9))) for _ in range(3)] + [str(i)] for i in range(n)]


def as_csv(rows, header, end="\n"):
    out = io.StringIO()
    writer = csv.writer(out, lineterminator=end, quoting=csv.QUOTE_ALL)
    writer.writerows([header, *rows])
    return out.getvalue()


@pytest.mark.parametrize("size", [48, 333, 1 << 20])
def test_any_split_gives_the_same_records(spark, tmp_path, splits, size):
    rows = wild_rows(1, 120)
    (tmp_path / "a.csv").write_text(as_csv(rows, ["content", "username", "urls", "no"]), newline="")
    (tmp_path / "b.csv").write_text(as_csv(rows[:9], ["no2", "content", "more", "no"], "\r\n"), newline="")
    (tmp_path / "c.csv").write_text("no\n", newline="")
    splits(size)
    found = posts.read_csv_records(spark, str(tmp_path))
    assert found.columns[:-1] == ["content", "urls", "username", "more", "no", "no2", "source_file"]
    got = {(r["source_file"], r["no"]): r for r in found.collect()}
    assert len(got) == 129
    for name, some, place in (("a.csv", rows, 0), ("b.csv", rows[:9], 1)):
        for row in some:
            value = row[place]
            missing = value in posts.CSV_MISSING
            assert got[name, row[3]]["content"] == (None if missing else value), (name, row)
    assert got["a.csv", "5"]["more"] is None and got["b.csv", "5"]["username"] is None


@pytest.mark.parametrize("size", [24, 1 << 20])
def test_records_come_in_file_order(spark, tmp_path, splits, size):
    rows = wild_rows(2, 60)
    (tmp_path / "a.csv").write_text(as_csv(rows, ["a", "b", "c", "no"]), newline="")
    splits(size)
    ordered = records.csv_records(spark, str(tmp_path)).orderBy("block", "row").select("record").collect()
    numbers = [next(csv.reader(io.StringIO(r["record"], newline="")))[3] for r in ordered]
    assert numbers == [str(i) for i in range(60)]


def test_quotes_inside_plain_cells_open_nothing(spark, tmp_path, splits):
    (tmp_path / "a.csv").write_text('username,content\nann,5" wide\nbob,"two\nlines"\ncat,say ""hi""\n\n  \ndan,"q ""x"" ,"\n', newline="")
    splits(8)
    got = {r["username"]: r["content"] for r in posts.read_csv_records(spark, str(tmp_path)).collect()}
    assert got == {"ann": '5" wide', "bob": "two\nlines", "cat": 'say ""hi""', "dan": 'q "x" ,'}


@pytest.mark.parametrize(("line", "outside", "inside"), [
    ("a,b", False, True), ('"a', True, False), ('"a""', True, True), ('"a"",', True, True), ('x"', False, False), ('a","b', True, True), ("", False, True), ('""', False, True), ('"",""', False, False),
])
def test_states(line, outside, inside):
    plain = {state: _walk(line, state) for state in (False, True)}
    assert {state: records.ends_inside(line, state) for state in (False, True)} == plain
    assert plain[False] == outside


def _walk(line, inside):
    """One character at a time."""
    state = "in" if inside else "start"
    for c in line:
        if state == "in":
            state = "quote" if c == '"' else "in"
        elif state == "quote" and c == '"':
            state = "in"
        elif c == ",":
            state = "start"
        elif state == "start" and c == '"':
            state = "in"
        else:
            state = "plain"
    return state == "in"


def test_states_of_random_lines():
    rng = random.Random(3)
    for _ in range(4000):
        line = "".join(rng.choice('ab",') for _ in range(rng.randrange(14)))
        for state in (False, True):
            assert records.ends_inside(line, state) == _walk(line, state), (line, state)
    begins, end = records._states(pa.array(['a,"x', "y", 'z"', "b"]), False)
    assert begins.tolist() == [False, True, True, False] and end is False


def test_no_task_reads_a_whole_file(spark, tmp_path, splits):
    (tmp_path / "a.csv").write_text(as_csv(wild_rows(4, 400), ["a", "b", "c", "no"]), newline="")
    splits(2000)
    assert records.csv_records(spark, str(tmp_path)).select(F.spark_partition_id()).distinct().count() > 4


def test_odd_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text("username,,Content,content\nann,1,2,3\n", newline="")
    found = posts.read_csv_records(spark, str(tmp_path))
    row = found.first().asDict()
    assert (row["username"], row["_c1"], row["Content2"], row["content3"]) == ("ann", "1", "2", "3")
    (tmp_path / "a.csv").write_text("", newline="")
    (tmp_path / "b.csv").write_text("username\n", newline="")
    assert posts.read_csv_records(spark, str(tmp_path)).count() == 0
