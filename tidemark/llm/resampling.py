"""Resampling towards a target distribution, by hashed words and word pairs.

Corpus and target texts are counted into buckets of their features; a bucket's gain is the log of how much
likelier it is in the target. A document's weight is the mean gain of its features; Gumbel noise from a hash of its id is
added, and the highest scores are drawn, which samples documents without replacement by their weights.

Words are found by an Aho-Corasick automaton. Its entries are the distinct words met so far with a delimiter on both sides, so
every hit is a whole word, and carry payloads: the word's checksum, that of the word behind a space, and its length. A
scan emits payloads in text order. The checksum of a word pair is composed from those of two neighbours (the left one
moved on by the length of the right one) and never touches its bytes. Words that aren't in the dictionary, the gaps of a
scan, get their payload from their bytes and enter it once they repeat; words of more than ``LONGEST`` bytes stay out. The
dictionary holds ``DICTIONARY`` words at most, and no result depends on which.

Texts are scanned twice, once to count, once to score. Counting sends a row per bucket and task. Only ids, sizes and
scores are sorted for the draw.

Defined results: a null or empty text, and one of delimiters only, has no features and weight 0. A null id hashes as ``null``; of equal
scores the smaller id is drawn first, null ids last. Repeated rows are drawn each by itself. An empty corpus has no rows; without
target texts all target counts are 0. Other columns aren't read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, islice

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import bytes_of
from tidemark.operators.series import numbered
from tidemark.session import sized_shuffles, stage

BUCKETS = 10_000
LEAST_WORDS = 20
PERCENT = 25
SEED = "7"
LONGEST = 64
DICTIONARY = 60_000
GROWTH = 2_000
SLICE_BYTES = 1 << 20
HITS = 1 << 16
ROW_BYTES = 64
# Fixed value: the polynomial of crc32, reflected.
POLYNOMIAL = 0xEDB88320


def _fold() -> bytes:
    """Byte table: A-Z become a-z, every delimiter a space; what is left unlike a space belongs to words."""
    table = bytearray(range(256))
    for code in range(128):
        kept = chr(code).lower() if chr(code).isalnum() else " "
        table[code] = ord(kept)
    return bytes(table)


FOLD = _fold()


def _zero_byte(crc: np.ndarray) -> np.ndarray:
    """Checksums with one zero byte more, as a linear map: without the inversions at both ends."""
    for _ in range(8):
        crc = (crc >> np.uint32(1)) ^ np.where(crc & np.uint32(1), np.uint32(POLYNOMIAL), np.uint32(0))
    return crc


@lru_cache(maxsize=1)
def _shift_tables() -> np.ndarray:
    """[length, which byte, its value]: what a byte of a checksum becomes behind so many more bytes."""
    base = (np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None]).astype(np.uint32)
    tables = [base]
    for _ in range(LONGEST + 1):
        tables.append(_zero_byte(tables[-1]))
    return np.stack(tables)


def _moved(crc: np.ndarray, tables: np.ndarray) -> np.ndarray:
    parts = [tables[k][(crc >> np.uint32(8 * k)) & np.uint32(255)] for k in range(4)]
    return parts[0] ^ parts[1] ^ parts[2] ^ parts[3]


@lru_cache(maxsize=64)
def _power(k: int) -> np.ndarray:
    """Tables that move a checksum on by 2**k bytes."""
    return _shift_tables()[1] if k == 0 else np.stack([_moved(t, _power(k - 1)) for t in _power(k - 1)])


def shift(crc: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Checksums moved on by the length of what follows; xor with its checksum gives that of both."""
    tables = _shift_tables()
    near = np.minimum(sizes, LONGEST + 1)
    flat, at = tables.ravel(), near * 1024
    out = flat[at + (crc & np.uint32(255))]
    for k in range(1, 4):
        out ^= flat[at + 256 * k + ((crc >> np.uint32(8 * k)) & np.uint32(255))]
    for i in np.flatnonzero(sizes > LONGEST + 1):
        value, rest = crc[i : i + 1], int(sizes[i])
        for k in range(rest.bit_length()):
            if rest >> k & 1:
                value = _moved(value, _power(k))
        out[i] = value[0]
    return out


class WordScanner:
    """Payloads of the words of folded bytes, by an automaton over words met before.

    A word enters the dictionary when it is met a second time while the first is remembered, so rare words leave its room to others.
    """

    def __init__(self):
        self._restart()

    def _restart(self) -> None:
        self.known: dict[bytes, int] = {}
        self.once: set[bytes] = set()
        self.payload = np.zeros((3, DICTIONARY), dtype=np.int64)
        self.automaton, self.built = None, 0

    def _meet(self, word: bytes, payload: tuple[int, int, int]) -> None:
        if len(word) > LONGEST or len(self.known) == DICTIONARY:
            return
        if word in self.once:
            self.once.discard(word)
            self.payload[:, len(self.known)] = payload
            self.known[word] = len(self.known)
        else:
            if len(self.once) == DICTIONARY:
                self.once.clear()
            self.once.add(word)

    def _build(self) -> None:
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for word, at in self.known.items():
            self.automaton.add_word(f" {word.decode('latin-1')} ", at)
        self.automaton.make_automaton()
        self.built = len(self.known)

    def scan(self, folded: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """(checksum, checksum behind a space, length) of every word; words lie between starts and ends."""
        if len(self.known) - self.built > max(GROWTH, self.built // 4) or self.built < len(self.known) == DICTIONARY:
            self._build()
        slot = np.full(len(starts), -1, dtype=np.int64)
        if self.automaton is not None:
            hits = self.automaton.iter(f" {folded.decode('latin-1')} ")
            while len(part := np.fromiter(chain.from_iterable(islice(hits, HITS)), dtype=np.int64)):
                # a hit ends at the delimiter behind its word, and the added space in front moved all places by one
                slot[np.searchsorted(ends, part[::2] - 1)] = part[1::2]
        out = np.empty((3, len(starts)), dtype=np.int64)
        gaps = np.flatnonzero(slot < 0)
        for i, first, last in zip(gaps.tolist(), starts[gaps].tolist(), ends[gaps].tolist()):
            word = folded[first:last]
            at = self.known.get(word)
            if at is None:
                out[:, i] = payload = _payload(word)
                self._meet(word, payload)
            else:
                slot[i] = at
        found = slot >= 0
        out[:, found] = self.payload[:, slot[found]]
        if len(self.known) == DICTIONARY and 2 * len(gaps) > len(starts):
            self._restart()  # texts of another kind
        return out


def _payload(word: bytes) -> tuple[int, int, int]:
    return zlib.crc32(word), zlib.crc32(b" " + word), len(word)


def _slices(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    """Runs of texts of about SLICE_BYTES; a longer text is a run of its own."""
    first = held = 0
    for i, text in enumerate(texts):
        if held and held + len(text) > SLICE_BYTES:
            yield first, i
            first, held = i, 0
        held += len(text) + 1
    if first < len(texts):
        yield first, len(texts)


def features_of(texts: list[bytes], scanner: WordScanner) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bucket and text number of every word, then of every word pair, of a few texts."""
    folded = b"\n".join(texts).translate(FOLD)
    inside = np.zeros(len(folded) + 2, dtype=bool)
    inside[1:-1] = np.frombuffer(folded, np.uint8) != 32
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    bounds = np.cumsum([len(t) + 1 for t in texts])
    owner = np.searchsorted(bounds, starts, "right")
    own, spaced, sizes = scanner.scan(folded, starts, ends)
    both = np.flatnonzero(owner[1:] == owner[:-1])
    left = shift(own[both].astype(np.uint32), sizes[both + 1] + 1)
    pairs = left.astype(np.int64) ^ spaced[both + 1]
    return own % BUCKETS, owner, pairs % BUCKETS, owner[both]


@lru_cache(maxsize=1)
def scanner() -> WordScanner:
    """One dictionary per worker: words met in a task serve the next ones."""
    return WordScanner()


def count_buckets(texts: DataFrame, text: str = "text") -> np.ndarray:
    """Features per bucket over all rows. The driver receives a row per bucket."""

    def run(batches):
        total = np.zeros(BUCKETS, dtype=np.int64)
        for batch in batches:
            data = bytes_of(batch.column(0))
            for first, last in _slices(data):
                words, _, pairs, _ = features_of(data[first:last], scanner())
                total += np.bincount(words, minlength=BUCKETS) + np.bincount(pairs, minlength=BUCKETS)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(used, pa.int64()), "n": pa.array(total[used], pa.int64())})

    counted = texts.select(F.col(text).alias("text")).mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    found = np.zeros(BUCKETS, dtype=np.int64)
    for row in counted.collect():
        found[row["bucket"]] = row["n"]
    return found


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Log ratio of target to corpus in thousandths, rounded down, per bucket; both counts smoothed by one."""
    s, t = corpus.astype(float), target.astype(float)
    return np.floor(1000 * np.log((t + 1) * (s.sum() + BUCKETS) / ((s + 1) * (t.sum() + BUCKETS)))).astype(np.int64)


def weigh(docs: DataFrame, gain: np.ndarray, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_words, n_features, weight): the mean gain of a document's features, rounded down."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches):
        for batch in batches:
            data = bytes_of(batch.column("text"))
            words, sums = np.zeros(len(data), dtype=np.int64), np.zeros(len(data), dtype=np.int64)
            for first, last in _slices(data):
                n = last - first
                own, owner, pairs, pair_owner = features_of(data[first:last], scanner())
                words[first:last] = np.bincount(owner, minlength=n)
                for buckets, owners in ((own, owner), (pairs, pair_owner)):
                    # whole numbers far below 2**53 add up exactly as doubles
                    sums[first:last] += np.bincount(owners, weights=gain[buckets], minlength=n).astype(np.int64)
            features = np.maximum(2 * words - 1, 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(words), pa.array(features), pa.array(np.where(features > 0, sums // np.maximum(features, 1), 0))],
                names=["key", "n_words", "n_features", "weight"],
            )

    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return rows.mapInArrow(run, f"key {kind}, n_words long, n_features long, weight long")


def noise(key: str, seed: str = SEED) -> Column:
    """Gumbel noise in thousandths from the sha256 of seed and key."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit("null"))), 256)
    drawn = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.ln(-F.ln((drawn + 0.5) / F.lit(4294967296.0)))).cast("long")


def resample(
    docs: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text", target_text: str = "text",
    percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: str = SEED,
) -> DataFrame:
    """(key, n_features, weight, score, rank) of every row; rank is null for rows that are not drawn.

    Drawn are ``percent`` of the documents with ``least_words`` words or more.
    """
    spark = docs.sparkSession
    gain = gains(count_buckets(docs, text), count_buckets(target, target_text))
    scored = stage(weigh(docs, gain, key, text).select(
        "key", "n_words", "n_features", "weight", (F.col("weight") + noise("key", seed)).alias("score"),
        F.monotonically_increasing_id().alias("_row"),
    ), "scored")
    able = F.col("n_words") >= least_words
    n = scored.where(able).count()
    drawn = percent * n // 100
    ordered = scored.where(able).select(
        (-F.col("score")).alias("_down"), F.col("key").isNull().alias("_last"), "key", "_row", "n_features", "weight", "score"
    )
    with sized_shuffles(spark, n * ROW_BYTES):
        placed = numbered(ordered, ordered.columns)
    rank = F.when(F.col("_index") < drawn, F.col("_index") + 1).cast("long").alias("rank")
    columns = [F.col("key").alias(key), "n_features", "weight", "score"]
    rest = scored.where(~able).select(*columns, F.lit(None).cast("long").alias("rank"))
    return placed.select(*columns, rank).unionByName(rest)
