"""Text and list normalisation."""

from __future__ import annotations

from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# What a word character is, and which characters separate words.
WORD = r"\p{L}\p{N}_"
MARKS = r"\p{M}"
# Everything but control characters and blanks, the most common characters first.
VISIBLE = (
    r"\x21-\x7e\xa1-\x{167f}\x{1681}-\x{1fff}\x{200b}-\x{2027}\x{202a}-\x{202e}"
    r"\x{2030}-\x{205e}\x{2060}-\x{2fff}\x{3001}-\x{10ffff}"
)

# Text made only of characters below U+0300 is always in composed form already.
_MAY_NEED_COMPOSING = r"[^\x00-\x{2ff}]"

_ITEM_BREAK = "\x1f"


@lru_cache(maxsize=None)
def _compose_udf():
    @F.arrow_udf(T.StringType())
    def compose(texts: pa.Array) -> pa.Array:
        # Not Arrow's utf8_normalize: its "NFC" leaves texts decomposed.
        import unicodedata

        return pa.array(
            [None if t is None else unicodedata.normalize("NFC", t) for t in texts.to_pylist()],
            pa.string(),
        )

    return compose


def compose(text: Column) -> Column:
    """Unicode NFC.

    Spark has no built-in for it. Only texts that can change are handed to the
    Arrow function; for all others it receives a null, which costs next to nothing.
    """
    pending = F.when(text.rlike(_MAY_NEED_COMPOSING), text)
    return F.coalesce(_compose_udf()(pending), text)


def squeeze(text: Column) -> Column:
    """Control characters and blanks become single spaces; ends are stripped."""
    # A single space between visible characters is already right and is not matched.
    # The rest is looked up only for what no visible ASCII character is, as most of a text is that.
    return F.trim(F.regexp_replace(text, rf"(?! [{VISIBLE}])[\x00-\x20\x7f-\x{{10ffff}}&&[^{VISIBLE}]]+", " "))


def normalize_text(text: Column) -> Column:
    """Composed, single-spaced text; null becomes the empty string."""
    return squeeze(F.coalesce(compose(text.cast("string")), F.lit("")))


def split_list(text: Column, strip_brackets: bool = False) -> Column:
    """Split an ``'a, b'`` text into lower-cased items.

    Brackets and quotes of a printed list stay in the items unless
    ``strip_brackets`` is set.
    """
    clean = normalize_text(text)
    if strip_brackets:
        clean = F.regexp_replace(clean, r"[\[\]'\"]", "")
    return F.filter(F.split(F.lower(clean), r"[,\s]+"), lambda item: item != "")


def clean_items(items: Column) -> Column:
    """Normalise and lower the items of a real list; blank items are dropped."""
    kept = F.filter(F.transform(items.cast("array<string>"), squeeze), lambda item: item != "")
    # One call per row: the break is a control character, so nothing composes across it,
    # and no squeezed item holds one.
    composed = compose(F.array_join(kept, _ITEM_BREAK))
    parts = F.transform(F.split(composed, _ITEM_BREAK), lambda item: F.lower(squeeze(item)))
    return F.coalesce(F.filter(parts, lambda item: item != ""), F.array().cast("array<string>"))


def parse_listish(value: Column, data_type: T.DataType, strip_brackets: bool = False) -> Column:
    """Lists that may come as text, as an array, or as either (variant)."""
    if isinstance(data_type, T.ArrayType):
        return clean_items(value)
    if isinstance(data_type, T.VariantType):
        items = F.try_variant_get(value, "$", "array<string>")
        text = F.try_variant_get(value, "$", "string")
        return F.when(items.isNotNull(), clean_items(items)).otherwise(
            split_list(text, strip_brackets)
        )
    return split_list(value, strip_brackets)


def extract_tags(text: Column, given: Column, sigil: str, marks: bool = False) -> Column:
    """``#word`` or ``@word`` in the text joined with a given list: lower, distinct, sorted.

    With ``marks`` a tag goes on over combining marks, which keeps tags of
    Indic scripts whole.
    """
    word = WORD + MARKS if marks else WORD
    found = F.regexp_extract_all(text, F.lit(f"({sigil}[{word}]+)"), F.lit(1))
    return F.array_sort(F.array_union(given, F.transform(found, F.lower)))


def extract_hashtags(text: Column, given: Column, marks: bool = False) -> Column:
    return extract_tags(text, given, "#", marks)


def extract_mentions(text: Column, given: Column, marks: bool = False) -> Column:
    return extract_tags(text, given, "@", marks)


def word_tokens(text: Column) -> Column:
    """Lower-cased runs of word characters."""
    return F.regexp_extract_all(F.lower(text), F.lit(f"([{WORD}]+)"), F.lit(1))


def bigrams(tokens: Column) -> Column:
    """All pairs of neighbouring tokens, joined by one space."""
    from_second = F.slice(tokens, F.lit(2), F.greatest(F.size(tokens) - 1, F.lit(0)))
    return F.transform(from_second, lambda token, i: F.concat(F.get(tokens, i), F.lit(" "), token))
