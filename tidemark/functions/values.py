"""Counts, timestamps, identifiers."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Layouts tried after ISO-8601, month first unless the first number can't be one.
_DATES = ("M/d/yyyy", "d/M/yyyy", "yyyy/M/d", "yyyy-M-d", "MMM d, yyyy", "MMMM d, yyyy", "d MMM yyyy", "d MMMM yyyy")
_CLOCKS = ("[ H:mm[:ss]]", " h:mm[:ss] a")
TIME_LAYOUTS = (
    "yyyyMMdd",
    "MMM d HH:mm:ss Z yyyy",
    "d MMM yyyy HH:mm:ss Z",
    *[day + clock for clock in _CLOCKS for day in _DATES],
)
_WEEKDAY = r"^(Mon|Tue|Wed|Thu|Fri|Sat|Sun)[a-z]*,?\s+"

# What each letter in a shown counter stands for, in the order tried.
METRIC_LETTERS = (("K", 1_000), ("M", 1_000_000), ("B", 1_000_000_000))
_DECIMAL = r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)(E[+-]?[0-9]+)?$"


# What counts as white space around a number or a time.
_SPACE = r"[\s\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"


def _stripped(text: Column) -> Column:
    # a text that begins and ends with a visible ASCII character is right already and costs no match
    bare = F.substring(text, 1, 1).between("!", "~") & F.substring(text, -1, 1).between("!", "~")
    return F.when(bare, text).otherwise(F.regexp_replace(text, f"^{_SPACE}|{_SPACE}$", ""))


def _text_to_int(text: Column) -> Column:
    bare = _stripped(text)
    digits = F.when(bare.rlike(r"^[+-]?[0-9]+(_[0-9]+)*$"), F.regexp_replace(bare, "_", ""))
    return digits.try_cast("bigint")


def coerce_int(value: Column, data_type: T.DataType) -> Column:
    """Whole number, or 0 for anything else.

    Numbers lose their fraction; text must be a plain whole number, so
    ``'12.0'`` and ``'1,234'`` are 0.
    """
    if isinstance(data_type, T.StringType):
        number = _text_to_int(value)
    elif isinstance(data_type, T.VariantType):
        is_text = F.schema_of_variant(value) == "STRING"
        number = F.when(
            is_text, _text_to_int(F.try_variant_get(value, "$", "string"))
        ).otherwise(F.try_variant_get(value, "$", "bigint"))
    else:
        number = value.try_cast("bigint")
    return F.coalesce(number, F.lit(0).cast("bigint"))


def _shape(layout: str) -> str:
    """A pattern that every text of a time layout matches: which of its characters are digits, letters or signs."""
    if "'" in layout:
        return ".*"
    out = []
    for run in re.finditer(r"([A-Za-z])\1*|.", layout):
        part = run.group()
        if part in "[]":
            out.append("(?:" if part == "[" else ")?")
        elif part[0] in "yudHhmsk" or part in ("M", "MM"):
            out.append("[0-9]+")
        elif part[0] == "M":
            out.append(r"[\p{L}.]+")
        elif part[0] == "a":
            out.append("[APap][Mm]")
        elif part[0].isalpha():
            out.append(".+")
        else:
            out.append(re.escape(part))
    return f"^{''.join(out)}$"


def _text_to_utc(text: Column, layouts: Sequence[str]) -> Column:
    bare = _stripped(text)
    iso = F.when(bare.rlike(r"^[0-9]{4}($|-[0-9]{1,2}($|-[0-9]{1,2}($|[T ]+[0-9:.]+[^apAP]*$)))"), F.try_to_timestamp(bare))
    undated = F.regexp_replace(F.regexp_replace(bare, _WEEKDAY, ""), r"(?i)\s*([ap])\.?m\.?$", " $1M")
    undated = F.regexp_replace(F.regexp_replace(undated, " aM$", " AM"), " pM$", " PM")

    def by_shape(shown: Column) -> Column:
        # a text that can't have a layout is never parsed by it: a failing parse costs far more than a failing match
        return F.coalesce(*[F.when(shown.rlike(_shape(layout)), F.try_to_timestamp(shown, F.lit(layout))) for layout in layouts])

    # in an array of one, so that the cleaned text is computed once for all layouts
    return F.coalesce(iso, F.get(F.transform(F.array(undated), by_shape), F.lit(0))) if layouts else iso


def to_utc(
    value: Column, data_type: T.DataType, layouts: Sequence[str] = TIME_LAYOUTS
) -> Column:
    """Timestamp in UTC (the session time zone must be UTC), null if unreadable.

    Text without an offset counts as UTC; bare numbers are nanoseconds since 1970.
    """
    if isinstance(data_type, T.TimestampType):
        return value
    if isinstance(data_type, (T.TimestampNTZType, T.DateType)):
        return value.cast("timestamp")
    if isinstance(data_type, T.StringType):
        return _text_to_utc(value, layouts)
    if isinstance(data_type, T.VariantType):
        is_text = F.schema_of_variant(value) == "STRING"
        return F.when(
            is_text, _text_to_utc(F.try_variant_get(value, "$", "string"), layouts)
        ).otherwise(_nanos_to_utc(F.try_variant_get(value, "$", "bigint")))
    if isinstance(data_type, T.NumericType):
        return _nanos_to_utc(value.try_cast("bigint"))
    return F.lit(None).cast("timestamp")


def _nanos_to_utc(nanos: Column) -> Column:
    # Decimal division: nanoseconds since 1970 do not fit a double.
    return F.timestamp_micros(F.floor(nanos.cast("decimal(19,0)") / F.lit(1000)).cast("bigint"))


def printed_time(ts: Column) -> Column:
    """``2024-01-01 00:00:00+00:00``, with six decimals if there is a fraction, ``NaT`` if null."""
    whole = F.date_format(ts, "yyyy-MM-dd HH:mm:ss")
    fine = F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    shown = F.when(F.unix_micros(ts) % 1_000_000 == 0, whole).otherwise(fine)
    return F.coalesce(F.concat(shown, F.lit("+00:00")), F.lit("NaT"))


def stable_uid(username: Column, ts: Column, content: Column) -> Column:
    """SHA-1 over author, time and text."""
    return F.sha1(F.concat_ws("|", username, printed_time(ts), content))


def content_key(username: Column, content: Column) -> Column:
    """MD5 over author and text, whatever the time."""
    return F.md5(F.concat(username, content))


def first_item(items: Column) -> Column:
    return F.coalesce(F.try_element_at(items, F.lit(1)), F.lit(""))


def calendar_date(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd")


def parse_metric(text: Column) -> Column:
    """Counter as shown on a page: ``1.2K``, ``3M``, ``1,234``.

    A letter counts wherever it stands if the rest is a number; otherwise only
    the digits are kept, so ``1.2`` is 12. No digits at all is 0.
    """
    shown = F.upper(F.trim(text))
    attempts = []
    for letter, factor in METRIC_LETTERS:
        rest = F.trim(F.regexp_replace(shown, f"[{letter},]", ""))
        number = F.when(rest.rlike(_DECIMAL), rest).try_cast("double") * F.lit(float(factor))
        attempts.append(F.when(shown.contains(letter), number.try_cast("bigint")))
    digits = F.regexp_replace(shown, "[^0-9]", "").try_cast("bigint")
    return F.coalesce(*attempts, digits, F.lit(0).cast("bigint"))
