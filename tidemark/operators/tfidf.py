"""TF-IDF over words and word pairs.

Texts are split by Spark. From there Arrow functions work on whole batches: they
turn words into numbers and count pairs, and terms per row, so that after words are
counted a document is never unfolded into rows, and no text is shuffled or joined.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import text as txt
from tidemark.session import stage

# Rows handled at a time inside a task, and how many words or terms they may hold; bounds of its memory for long texts.
SLICE = 1024
SLICE_ENTRIES = 1 << 18

_VOCABULARY_SCHEMA = T.StructType([
    T.StructField("term", T.StringType(), False),
    T.StructField("term_id", T.IntegerType(), False),
    T.StructField("corpus_count", T.LongType(), False),
])
_COUNTS_TYPE = T.StructType([
    T.StructField("ids", T.ArrayType(T.IntegerType())),
    T.StructField("tf", T.ArrayType(T.IntegerType())),
])


@dataclass(frozen=True)
class Vocabulary:
    """The kept terms; the position of a term is its id."""

    terms: tuple[str, ...]
    counts: tuple[int, ...]

    def __len__(self) -> int:
        return len(self.terms)

    def lookup(self) -> "Lookup":
        """How to find terms from words: a pair is found by the places of its two words."""
        split = [term.split(" ") for term in self.terms]
        words = sorted({word for parts in split for word in parts})
        place = {word: i for i, word in enumerate(words)}
        word_terms = np.full(len(words) + 1, -1)  # the last entry answers for unknown words
        pairs = []
        for number, parts in enumerate(split):
            if len(parts) == 1:
                word_terms[place[parts[0]]] = number
            else:
                pairs.append((place[parts[0]] * len(words) + place[parts[1]], number))
        codes, numbers = np.array(sorted(pairs) or [(-1, -1)]).T
        return Lookup(tuple(words), word_terms, codes, numbers)

    def table(self, spark: SparkSession) -> DataFrame:
        rows = [(t, i, c) for i, (t, c) in enumerate(zip(self.terms, self.counts))]
        return spark.createDataFrame(rows, _VOCABULARY_SCHEMA)


@dataclass(frozen=True)
class Lookup:
    """Words in order, the term of each word, and the terms of pairs by pair code."""

    words: tuple[str, ...]
    word_terms: np.ndarray
    pair_codes: np.ndarray
    pair_terms: np.ndarray


@dataclass(frozen=True)
class TermVectors:
    """One row per document with ``_ids`` and ``_tf``, and the idf by term id."""

    rows: DataFrame
    keys: tuple[str, ...]
    vocabulary: Vocabulary
    idf: tuple[float, ...]
    packed: DataFrame | None = None  # the rows as ``packed_rows``, if they are read many times


def row_sizes(lists: pa.Array) -> np.ndarray:
    """Length of each list, 0 for null."""
    return pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)


def find_words(tokens: pa.Array, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The row and the place in ``words`` of every token, -1 for unknown ones."""
    places = pc.fill_null(pc.index_in(tokens.flatten(), value_set=words), -1)
    rows = np.repeat(np.arange(len(tokens)), row_sizes(tokens))
    return rows, places.to_numpy(zero_copy_only=False).astype(np.int64)


def neighbour_codes(rows: np.ndarray, places: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The row and the code of every pair of known neighbours: left place x size + right place."""
    left, right = places[:-1], places[1:]
    known = (rows[:-1] == rows[1:]) & (left >= 0) & (right >= 0)
    return rows[:-1][known], left[known] * size + right[known]


def as_lists(values: np.ndarray, sizes: np.ndarray, kind: pa.DataType) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values, kind))


def row_runs(sizes: np.ndarray, rows: int = SLICE, entries: int = SLICE_ENTRIES) -> list[tuple[int, int]]:
    """Start and length of runs of at most ``rows`` rows and ``entries`` entries; a longer row is a run of its own."""
    ends, runs, start = np.cumsum(sizes), [], 0
    while start < len(sizes):
        before = ends[start - 1] if start else 0
        fitting = int(np.searchsorted(ends, before + entries, side="right"))
        stop = min(max(fitting, start + 1), start + rows)
        runs.append((start, stop - start))
        start = stop
    return runs or [(0, 0)]


def in_slices(function, *arrays: pa.Array) -> pa.Array:
    """Apply an array function to a few rows of lists at a time."""
    return pa.concat_arrays([function(*[a.slice(*run) for a in arrays]) for run in row_runs(row_sizes(arrays[0]))])


def _term_counts(rows: np.ndarray, places: np.ndarray, count: int, lookup: Lookup, size: int) -> pa.Array:
    """Kept terms and how often they occur, per row, from the places of its words in ``lookup.words``."""
    single = lookup.word_terms[places]
    pair_rows, codes = neighbour_codes(rows, places, len(lookup.words))
    near = np.searchsorted(lookup.pair_codes, codes).clip(max=len(lookup.pair_codes) - 1)
    found = lookup.pair_codes[near] == codes
    cells = np.concatenate([
        rows[single >= 0] * size + single[single >= 0],
        pair_rows[found] * size + lookup.pair_terms[near[found]],
    ])
    cells, tf = np.unique(cells, return_counts=True)
    sizes = np.bincount(cells // size, minlength=count)
    return pa.StructArray.from_arrays(
        [as_lists(cells % size, sizes, pa.int32()), as_lists(tf, sizes, pa.int32())], ["ids", "tf"]
    )


def count_terms(vocabulary: Vocabulary):
    """Arrow function from the tokens of a text to its kept terms and how often they occur."""
    lookup, size = vocabulary.lookup(), len(vocabulary)

    @F.arrow_udf(_COUNTS_TYPE)
    def counts(tokens: pa.Array) -> pa.Array:
        words = pa.array(lookup.words, pa.string())
        return in_slices(lambda part: _term_counts(*find_words(part, words), len(part), lookup, size), tokens)

    return counts


def _place_type(words: Sequence[str]) -> type:
    return np.int16 if len(words) < 1 << 15 else np.int32


def _place_words(words: Sequence[str]):
    """Arrow function from tokens to their places in ``words``, -1 for unknown ones, packed as bytes."""
    kind = _place_type(words)

    @F.arrow_udf(T.BinaryType())
    def places(tokens: pa.Array) -> pa.Array:
        listed = pa.array(words, pa.string())

        def some(part: pa.Array) -> pa.Array:
            found = find_words(part, listed)[1].astype(kind)
            ends = np.concatenate([[0], np.cumsum(row_sizes(part))]) * found.itemsize
            return pa.Array.from_buffers(
                pa.binary(), len(part), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(found)]
            )

        return in_slices(some, tokens)

    return places


def _placed_runs(packed: pa.Array, kind: type, rows: int = SLICE, entries: int = SLICE_ENTRIES):
    """Row and place of the words of some rows at a time, and how many rows these are."""
    sizes = pc.binary_length(packed).to_numpy(zero_copy_only=False) // np.dtype(kind).itemsize
    for start, count in row_runs(sizes, rows, entries):
        flat = np.frombuffer(b"".join(packed.slice(start, count).to_pylist()), kind).astype(np.int64)
        yield np.repeat(np.arange(count), sizes[start:start + count]), flat, count


def _count_placed(vocabulary: Vocabulary, words: Sequence[str]):
    """Arrow function from packed places in ``words`` to kept terms and how often they occur."""
    lookup, size, kind = vocabulary.lookup(), len(vocabulary), _place_type(words)
    place = {word: i for i, word in enumerate(lookup.words)}
    kept = np.array([*(place.get(word, -1) for word in words), -1])  # the last entry answers for unknown words

    @F.arrow_udf(_COUNTS_TYPE)
    def counts(packed: pa.Array) -> pa.Array:
        return pa.concat_arrays([
            _term_counts(rows, kept[places], count, lookup, size) for rows, places, count in _placed_runs(packed, kind)
        ])

    return counts


def _word_counts(df: DataFrame, tokens: Column) -> DataFrame:
    """``term, n``: words are counted with map-side combining."""
    # Exploding the expression itself, not a column made of it: for a column Spark
    # adds a filter on its size and would split every text again to evaluate that.
    return df.select(F.explode(tokens).alias("term")).groupBy("term").agg(F.count("*").alias("n"))


def _pair_counts(placed: DataFrame, words: Sequence[str]) -> DataFrame:
    """``code, n``: neighbours that are both listed, by ``neighbour_codes``."""
    size, kind = len(words), _place_type(words)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, places, _ in _placed_runs(batch.column(0), kind, 1 << 16, 2 * SLICE_ENTRIES):
                found = pa.array(neighbour_codes(rows, places, size)[1]).value_counts()
                yield pa.RecordBatch.from_arrays([found.field("values"), found.field("counts")], names=["code", "n"])

    counted = placed.select("_places").mapInArrow(count, "code bigint, n bigint")
    return counted.groupBy("code").agg(F.sum("n").alias("n"))


def _top(counts: DataFrame, by: Column | str, size: int) -> list:
    """The ``size`` most frequent rows; each task sends that many."""
    return counts.orderBy(F.desc("n"), by).limit(size).collect()


def _common_words(df: DataFrame, text: str, max_features: int) -> tuple[list[tuple[str, int]], list[str] | None]:
    """The most frequent words with their counts, and in order those that a kept pair can consist of.

    None where the words tied at the limit are too many to send to every task.
    """
    if max_features < 1:
        raise ValueError("max_features must be positive")
    bound = 2 * max_features + 1
    common = [(row["term"], row["n"]) for row in _top(_word_counts(df, txt.word_tokens(F.col(text))), "term", bound)]
    least = common[max_features - 1][1] if len(common) >= max_features else 0
    if len(common) < bound or common[-1][1] < least:
        # Words in order: codes then sort like the pairs they stand for.
        return common[:max_features], sorted(term for term, n in common if n >= least)
    return common[:max_features], None


def _placed(df: DataFrame, columns: Sequence[str], text: str, words: Sequence[str]) -> DataFrame:
    return df.select(*columns, _place_words(words)(txt.word_tokens(F.col(text))).alias("_places"))


def _vocabulary(
    common: list[tuple[str, int]], words: Sequence[str] | None, placed: DataFrame, text: str, max_features: int
) -> Vocabulary:
    """Words and pairs together; ``placed`` has the packed places of ``words``, or without them the texts."""
    if words is not None:
        named = [
            (f"{words[row['code'] // len(words)]} {words[row['code'] % len(words)]}", row["n"])
            for row in _top(_pair_counts(placed, words), "code", max_features)
        ]
    else:
        split = placed.select(txt.word_tokens(F.col(text)).alias("_tokens"))
        pairs = split.select(F.explode(txt.bigrams(F.col("_tokens"))).alias("term"))
        pairs = pairs.groupBy("term").agg(F.count("*").alias("n"))
        named = [(row["term"], row["n"]) for row in _top(pairs, "term", max_features)]
    best = sorted(common + named, key=lambda item: (-item[1], item[0]))[:max_features]
    return Vocabulary(tuple(term for term, _ in best), tuple(n for _, n in best))


def fit_vocabulary(df: DataFrame, text: str, max_features: int = 5000) -> Vocabulary:
    """The most frequent words and word pairs of the corpus, ties in term order.

    The vocabulary goes to the driver and to every task: ``max_features`` is its bound.

    Words are counted first. A pair occurs no more often than either of its
    words, so a pair with a word rarer than the last kept word cannot be kept,
    and the long tail of rare pairs, by far the largest part of the counts, is
    never shuffled; the others are counted as numbers. Only when the words tied at
    that limit are too many to send to every task are all pairs counted as text.
    """
    common, words = _common_words(df, text, max_features)
    placed = df if words is None else _placed(df, [], text, words)
    return _vocabulary(common, words, placed, text, max_features)


def idf_values(document_frequency: dict[int, int], documents: int, size: int) -> tuple[float, ...]:
    """ln((1 + N) / (1 + df)) + 1 by term id."""
    return tuple(
        math.log((1 + documents) / (1 + document_frequency.get(i, 0))) + 1 for i in range(size)
    )


def fit_vectors(
    df: DataFrame, keys: Sequence[str], text: str, max_features: int = 5000, carry: Sequence[str] = ()
) -> TermVectors:
    """Vocabulary, idf and one sparse row of counts per document, kept as a table.

    Two passes over the text: one counts words, one stores the places of common words as numbers, from which
    pairs and terms are counted. Documents are counted on the way. Documents without a
    kept term have no row, unless further columns are to be carried along: then every
    document has one, and nothing needs to be joined to it later.
    """
    keys = tuple(keys)
    columns = tuple(dict.fromkeys([*keys, *carry]))
    documents = Observation()
    observed = df.observe(documents, F.count(F.lit(1)).alias("n"))
    common, words = _common_words(df, text, max_features)
    if words is not None:
        placed = stage(_placed(observed, columns, text, words), "word-places")
        vocabulary = _vocabulary(common, words, placed, text, max_features)
        counts, source = _count_placed(vocabulary, words)(F.col("_places")), placed
    else:
        vocabulary = _vocabulary(common, words, df, text, max_features)
        counts, source = count_terms(vocabulary)(txt.word_tokens(F.col(text))), observed
    counted = source.select(*columns, counts.alias("_c"))
    rows = stage(counted.select(*columns, F.col("_c.ids").alias("_ids"), F.col("_c.tf").alias("_tf")), "term-vectors")
    idf = idf_values(_document_frequency(rows, len(vocabulary)), documents.get["n"], len(vocabulary))
    # Left out of the stored rows, not before: a filter on the counts would have them made twice, by two workers a task.
    return TermVectors(rows if carry else rows.where(F.size("_ids") > 0), keys, vocabulary, idf)


def _document_frequency(rows: DataFrame, size: int) -> dict[int, int]:
    """In how many rows each term is; a task sends at most one row per term, and so do all together."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, dtype=np.int64)
        for batch in batches:
            total += np.bincount(batch.column(0).flatten().to_numpy(zero_copy_only=False), minlength=size)
        ids = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(total[ids])], names=["id", "n"])

    counted = rows.select("_ids").mapInArrow(count, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n"))
    return {row["id"]: row["n"] for row in counted.collect()}


def unit_rows(ids: pa.Array, tf: pa.Array, idf: Sequence[float]) -> tuple[np.ndarray, ...]:
    """Flat ids, the weights that give each row length 1, and the row of each entry."""
    flat = ids.flatten().to_numpy(zero_copy_only=False)
    rows = np.repeat(np.arange(len(ids)), row_sizes(ids))
    weights = tf.flatten().to_numpy(zero_copy_only=False) * np.asarray(idf)[flat]
    return flat, scaled(weights, rows, len(ids)), rows


def scaled(weights: np.ndarray, rows: np.ndarray, count: int) -> np.ndarray:
    """Weights that give each of ``count`` rows length 1."""
    return weights / np.sqrt(np.bincount(rows, weights=weights * weights, minlength=count))[rows]


def weigh(vectors: TermVectors):
    """Arrow function from ids and counts to weights: tf x idf, scaled to length 1 per row."""
    idf = vectors.idf

    @F.arrow_udf(T.ArrayType(T.DoubleType()))
    def weights(ids: pa.Array, tf: pa.Array) -> pa.Array:
        return in_slices(
            lambda i, t: as_lists(unit_rows(i, t, idf)[1], row_sizes(i), pa.float64()), ids, tf
        )

    return weights


def tfidf_weights(
    df: DataFrame, keys: Sequence[str], text: str, max_features: int = 5000
) -> DataFrame:
    """``keys, term, tf, weight``, every document scaled to length 1."""
    vectors = fit_vectors(df, keys, text, max_features)
    weights = weigh(vectors)(F.col("_ids"), F.col("_tf")).alias("_weights")
    entries = vectors.rows.select(*keys, "_ids", "_tf", weights).select(
        *keys, F.explode(F.arrays_zip("_ids", "_tf", "_weights")).alias("_e")
    )
    terms = vectors.vocabulary.table(df.sparkSession).select("term", F.col("term_id").alias("_id"))
    return entries.join(F.broadcast(terms), F.col("_e._ids") == F.col("_id")).select(
        *keys, "term", F.col("_e._tf").alias("tf"), F.col("_e._weights").alias("weight")
    )
