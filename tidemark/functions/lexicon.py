"""Word-list scores and engagement."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The default word lists.
BULL_WORDS = (
    "buy", "bull", "long", "breakout", "rally", "support", "up", "green", "accumulate", "entry",
)
BEAR_WORDS = (
    "sell", "bear", "short", "breakdown", "resistance", "down", "red", "exit", "dump",
)
URGENCY_WORDS = ("now", "today", "alert", "immediate", "intraday", "urgent", "live")


def words_of(content: Column) -> Column:
    """Lower-cased words of normalised text, where only single spaces separate words."""
    return F.array_remove(F.split(F.lower(content), " "), "")


def matches(words: Column, lexicon: Iterable[str]) -> Column:
    """The words found in a lexicon, repeats included. Punctuation is not stripped."""
    listed = sorted(set(lexicon))
    return F.filter(words, lambda word: word.isin(listed))


def share(hits: Column, words: Column) -> Column:
    """Hits per word, 0 for empty text."""
    return hits / F.greatest(F.size(words), F.lit(1))


def lexicon_polarity(
    content: Column,
    bull: Iterable[str] = BULL_WORDS,
    bear: Iterable[str] = BEAR_WORDS,
) -> Column:
    """(bull words - bear words) / words."""
    words = words_of(content)
    return share(F.size(matches(words, bull)) - F.size(matches(words, bear)), words)


def urgency_score(content: Column, urgent: Iterable[str] = URGENCY_WORDS) -> Column:
    """Urgent words / words."""
    words = words_of(content)
    return share(F.size(matches(words, urgent)), words)


def engagement(likes: Column, retweets: Column, replies: Column) -> Column:
    """ln(1 + all reactions); null when the sum is below -1."""
    return F.log1p(likes + retweets + replies)
