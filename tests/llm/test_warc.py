import brute
import pytest
from pyspark.sql import functions as F

from tidemark.llm import warc

PAGES = [
    (1, "http://a", "<p>x</p>"), (2, "http://b", "<p>x</p>"), (2, "http://b", "<p>x</p>"), (3, None, None), (4, "u\r\nv", ""),
    (5, "http://c", "é WARC/1.1\r\n\r\n" * 9), (None, "http://d", "<p>x</p>"), (None, "http://e", "only null"), (7, "f", "z" * 300000),
    (-8, "g", "h"), (9, "g", "h"),
]


def expected(revisit_from=0):
    first = {}
    for i, _, html in PAGES:
        html = html or ""
        if i is not None:
            first[html] = min(first.get(html, i), i)
    for i, _, html in PAGES:
        data = (html or "").encode()
        least = first.get(html or "")
        response = least is None or i == least or len(data) < revisit_from
        yield (i, len(data), brute.sha1_base32(data), "response" if response else "revisit", None if response else least)


def told(records):
    return records.select(
        warc.page_of(F.col("record_id")).alias("i"), "payload_bytes", "digest", "record_type",
        warc.page_of(F.col("refers_to")).alias("r"), "payload",
    )


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame(PAGES, "page_id long, url string, html string").selectExpr("*", "1 as same", "2 as n", "3 as first_id")


@pytest.mark.parametrize("split", [7, 100, 1 << 25])
def test_round_trip_by_any_split(pages, same_rows, split):
    files = warc.write_warc(pages.coalesce(2))
    records = told(warc.read_warc(files, split_bytes=split))
    same_rows(records, expected(), "i", "payload_bytes", "digest", "record_type", "r")
    bodies = {bytes(r["payload"]).decode() for r in records.where("record_type = 'response'").collect()}
    assert bodies == {t or "" for _, _, t in PAGES}


def test_small_payloads_stay_responses(pages, same_rows):
    records = told(warc.read_warc(warc.write_warc(pages, revisit_from=5)))
    same_rows(records, expected(5), "i", "payload_bytes", "digest", "record_type", "r")


def test_magic_inside_a_member_is_no_record(tmp_path):
    inner = warc.record(1, "u", b"inner", None, 5)
    outer = warc.record(2, "u", inner * 3, None, 0)  # stored, so the inner members stand there as they are
    path = tmp_path / "x"
    path.write_bytes(outer + warc.record(3, "u", b"last", None, 5))
    with open(path, "rb") as raw:
        import pyarrow as pa

        members = warc.Members(pa.PythonFile(raw, mode="r"), path.stat().st_size)
        assert [warc.parse(d)["record_id"] for _, d in members.owned(0, path.stat().st_size)] == ["urn:page:2", "urn:page:3"]


def test_broken_member_is_an_error(tmp_path):
    import pyarrow as pa

    good = warc.record(1, "u", b"x" * 500, None, 5)
    path = tmp_path / "x"
    path.write_bytes(good + good[: len(good) // 2])
    with open(path, "rb") as raw, pytest.raises(Exception):
        list(warc.Members(pa.PythonFile(raw, mode="r"), path.stat().st_size).owned(0, path.stat().st_size))


def test_no_pages(pages):
    assert warc.read_warc(warc.write_warc(pages.limit(0))).count() == 0
