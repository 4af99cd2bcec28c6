from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import lexicon, values


def test_counts_from_text(column):
    given = ["12", " 12 ", "-3", "+4", "1_000", "12.0", "1,234", "1.2K", "", None, "1e3", "9" * 30]
    assert column(given, "string", lambda x: values.coerce_int(x, T.StringType())) == [
        12, 12, -3, 4, 1000, 0, 0, 0, 0, 0, 0, 0,
    ]


def test_counts_from_numbers(column):
    given = [12.7, -1.9, None, float("nan"), float("inf")]
    assert column(given, "double", lambda x: values.coerce_int(x, T.DoubleType())) == [12, -1, 0, 0, 0]


def test_counts_from_json(spark):
    rows = spark.createDataFrame([(j,) for j in ("12.7", '"12.7"', '" 5 "', "true", "null", "[1]")], "j string")
    read = rows.select(values.coerce_int(F.parse_json("j"), T.VariantType()).alias("y"))
    assert [row["y"] for row in read.collect()] == [12, 0, 5, 1, 0, 0]


def test_times(column):
    cases = {
        "2024-01-01T10:00:00Z": datetime(2024, 1, 1, 10),
        "2024-01-01T10:00:00+02:00": datetime(2024, 1, 1, 8),
        "2024-01-01 10:00:00": datetime(2024, 1, 1, 10),
        "2024-01-01 10:00:00.123456": datetime(2024, 1, 1, 10, 0, 0, 123456),
        "2024-01-01": datetime(2024, 1, 1),
        "20240102": datetime(2024, 1, 2),
        "Wed Oct 10 20:19:24 +0000 2018": datetime(2018, 10, 10, 20, 19, 24),
        "1/2/2024 3:04": datetime(2024, 1, 2, 3, 4),
        "junk": None,
        "": None,
        None: None,
    }
    as_text = lambda x: F.date_format(values.to_utc(x, T.StringType()), "yyyy-MM-dd HH:mm:ss.SSSSSS")
    shown = [t and t.strftime("%Y-%m-%d %H:%M:%S.%f") for t in cases.values()]
    assert column(list(cases), "string", as_text) == shown


def test_numbers_are_nanoseconds(column):
    shown = lambda x: F.unix_micros(values.to_utc(x, T.LongType()))
    assert column([1704067200123456789, 0, None], "bigint", shown) == [1704067200123456, 0, None]


def test_uid_prints_time_like_pandas(column):
    import hashlib

    times = [1704067200000000, 1704067200500000, None]
    printed = ["2024-01-01 00:00:00+00:00", "2024-01-01 00:00:00.500000+00:00", "NaT"]
    uid = lambda x: values.stable_uid(F.lit("ann"), F.timestamp_micros(x), F.lit("hi é"))
    assert column(times, "bigint", uid) == [
        hashlib.sha1(f"ann|{p}|hi é".encode()).hexdigest() for p in printed
    ]


@pytest.mark.parametrize("shown, number", [
    (None, 0), ("", 0), ("1.2K", 1200), ("3M", 3_000_000), ("2b", 2_000_000_000), ("1,234", 1234), ("1.2", 12),
    ("1.5K replies", 15), ("abc", 0), (" 7 ", 7), ("K", 0), ("1,5K", 15_000), ("K1M", 1), ("4.35K", 4350),
    ("1.5M likes", 15), ("NaNK", 0), ("1K2", 12_000),
])
def test_metrics(column, shown, number):
    assert column([shown], "string", values.parse_metric) == [number]


def test_engagement(column):
    import math

    zero = F.lit(0)
    assert column([0, 9, None], "bigint", lambda x: lexicon.engagement(x, zero, zero)) == [
        0.0, pytest.approx(math.log(10)), None,
    ]


@pytest.mark.parametrize("shown, expected", [
    ("2024/01/05", "2024-01-05 00:00:00"), ("1/2/2024 3:04 PM", "2024-01-02 15:04:00"), ("2024-01-01 03:04 PM", "2024-01-01 15:04:00"),
    ("Jan 5, 2024 10:00", "2024-01-05 10:00:00"), ("January 5, 2024", "2024-01-05 00:00:00"), ("13/01/2024", "2024-01-13 00:00:00"),
    ("1/13/2024 3:04pm", "2024-01-13 15:04:00"), (" 2024-01-05\t", "2024-01-05 00:00:00"), ("5 January 2024 10:00:01", "2024-01-05 10:00:01"),
    ("2024-13-45", None),
])
def test_more_time_layouts(column, shown, expected):
    (found,) = column([shown], "string", lambda x: values.to_utc(x, T.StringType()))
    assert (str(found) if found else None) == expected


def test_any_white_space_around_counts(column):
    assert column(["12\t", "\u00a07\n", "1 2"], "string", lambda x: values.coerce_int(x, T.StringType())) == [12, 7, 0]


def test_strip_of_texts_that_need_none(column):
    given = ["7", " 7", "7 ", "　 7 ", "-7", "", " ", None, " 7", "~!", "é7", "7 7"]
    assert column(given, "string", values._stripped) == ["7", "7", "7", "7", "-7", "", "", None, "7", "~!", "é7", "7 7"]
