import re
import unicodedata

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import lexicon, text

TEXTS = [
    None, "", "  ", "café", "  a　 b", "a\tb\n\nc", "a\u0085b", "x\u0000y",
    "가 Ω", " single spaces stay ", "​zero width stays​", "\U0001f600  ok",
    "a ́b", " ́",
]


def plain_normalize(value):
    value = unicodedata.normalize("NFC", value or "")
    value = re.sub("[\u0000-\u001f\u007f-\u009f]", " ", value)
    return re.sub(r"\s+", " ", value).strip()


def test_normalize_text(column):
    assert column(TEXTS, "string", text.normalize_text) == [plain_normalize(t) for t in TEXTS]


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(st.characters(blacklist_categories=("Cs",)), max_size=30), min_size=40, max_size=60))
def test_normalize_any_text(column, values):
    assert column(values, "string", text.normalize_text) == [plain_normalize(v) for v in values]


def test_split_list(column):
    values = [None, "", "a, B", "a b", "['a','b']", " ,, #X\n@y "]
    found = column(values, "string", lambda x: text.parse_listish(x, T.StringType()))
    assert found == [[], [], ["a", "b"], ["a", "b"], ["['a'", "'b']"], ["#x", "@y"]]
    bare = column(["['a','b']"], "string", lambda x: text.parse_listish(x, T.StringType(), True))
    assert bare == [["a", "b"]]


def test_real_lists_are_not_split(column):
    kind = T.ArrayType(T.StringType())
    values = [None, [], ["A", " "], ["two words", None, "café"], ["x\ty"]]
    found = column(values, "array<string>", lambda x: text.parse_listish(x, kind))
    assert found == [[], [], ["a"], ["two words", "café"], ["x y"]]


def test_lists_of_either_kind(spark):
    rows = spark.createDataFrame([('["A", " ", 3]',), ('"a, b"',), ("null",)], "j string")
    variant = rows.select(F.parse_json("j").alias("v"))
    found = variant.select(text.parse_listish(F.col("v"), T.VariantType()).alias("y")).collect()
    assert [row["y"] for row in found] == [["a", "3"], ["a", "b"], []]


def test_hashtags(column):
    none = F.array().cast("array<string>")
    values = ["#née ##x #X", "#निफ्टी up", "no tag", ""]
    found = column(values, "string", lambda x: text.extract_hashtags(x, none))
    assert found == [sorted(["#née", "#x"]), ["#न"], [], []]
    whole = column(values[1:2], "string", lambda x: text.extract_hashtags(x, none, marks=True))
    assert whole == [["#निफ्टी"]]


def test_tags_join_the_given_list(column):
    given_list = F.array(F.lit("@b"), F.lit("@a"), F.lit("@b"))
    assert column(["hi @C"], "string", lambda x: text.extract_mentions(x, given_list)) == [["@a", "@b", "@c"]]


def test_bigrams(column):
    values = ["", "One", "one two THREE", "snake_case it's"]
    found = column(values, "string", lambda x: text.bigrams(text.word_tokens(x)))
    assert found == [[], [], ["one two", "two three"], ["snake_case it", "it s"]]


def test_polarity_and_urgency(column):
    values = ["", "buy", "Buy SELL buy now", "buy! #buy", "bull bull bear today live"]
    assert column(values, "string", lexicon.lexicon_polarity) == [0.0, 1.0, 0.25, 0.0, 0.2]
    assert column(values, "string", lexicon.urgency_score) == [0.0, 0.0, 0.25, 0.0, 0.4]
