"""Removal of repeated byte strings by a hash-compared suffix sort.

A byte goes if it lies in a ``length``-byte string that also starts anywhere else in the corpus, judged on the
texts as given. Two suffixes are compared by prefix polynomial hashes: a binary search over lengths finds
their common extension, and the byte behind it their order. A mergesort over suffixes then
takes logarithmic comparisons, and repeated strings are neighbours that share ``length`` bytes. Equal
hashes are verified on the bytes.

Not every suffix of the corpus is sorted at once. Each window of ``length`` bytes picks as anchor the
place in it with the smallest hash of ``SEED`` bytes, so equal windows pick equal anchors:

1. Tasks list anchors with the stretch of windows that pick them, about one per 170 bytes.
   Anchors whose seed is found once are done: none of their windows repeats.
2. Stretches that are equal as a whole (128-bit digests) are settled without a sort, copies of any number.
3. The rest, stretches that differ somewhere around a repeated seed, are fetched from their texts, put together
   by seed, and their suffixes sorted. A seed with more than ``GROUP`` different stretches isn't
   gathered: each of its windows becomes a row, counted by digest with map-side combining.

Texts are shuffled twice, for 3 and for the removal; otherwise rows are a few numbers each.

With ``words`` a byte also goes if it lies in a passage of that many words that starts anywhere else, however few bytes
it has. Steps 1 to 3 are the same, over 64-bit codes of the words instead of bytes; gaps between words may
differ, those inside a passage go with it. Both are fetched in one shuffle of the texts.

Defined results: a null or empty text has no bytes; one below ``length`` loses none. Repeated rows are separate
occurrences, so long copies go as a whole. Ids may be null or repeated. Added columns are
``n_bytes``, ``n_removed``, ``n_spans`` and ``kept`` (binary); input columns of these names are replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import GAP_BYTES, Scratch, bytes_of, mix

SEED = 64
GROUP = 4_000
CHUNK_WINDOWS = 300_000
BASE = 0x9E3779B97F4A7C15

_powers: list[np.ndarray] = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse by 2**64."""
    if len(_powers[0]) < n:
        for k, base in enumerate((BASE, pow(BASE, -1, 1 << 64))):
            steps = np.full(max(n, 2 * len(_powers[k])), base, dtype=np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps, dtype=np.uint64)
    return _powers[0][:n], _powers[1][:n]


class PrefixHash:
    """Polynomial hashes of all prefixes of a byte string; any substring's hash follows in one step."""

    def __init__(self, data: np.ndarray):
        up, self.down = powers(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:-1], out=self.sums[1:])

    def of(self, start: np.ndarray, size) -> np.ndarray:
        return (self.sums[start + size] - self.sums[start]) * self.down[start]

    def all(self, size: int) -> np.ndarray:
        n = len(self.sums) - size
        return (self.sums[size:] - self.sums[:n]) * self.down[:n]


def word_bounds(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where words start and end; a word is a run of anything but gaps."""
    gap = np.ones(len(data) + 2, dtype=bool)
    gap[1:-1] = np.isin(np.frombuffer(data, np.uint8), np.frombuffer(GAP_BYTES, np.uint8))
    edges = np.flatnonzero(gap[1:] != gap[:-1])
    return edges[::2], edges[1::2]


def word_codes(data: bytes) -> np.ndarray:
    starts, ends = word_bounds(data)
    return mix(PrefixHash(np.frombuffer(data, np.uint8)).of(starts, ends - starts))


def single_bytes(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.uint8)


@dataclass(frozen=True)
class Units:
    """What texts are strings of, and how many of them make a seed."""

    words: bool
    kind: type
    seed: int
    split: Callable[[bytes], np.ndarray]

    @property
    def width(self) -> int:
        return np.dtype(self.kind).itemsize


BYTES = Units(False, np.uint8, SEED, single_bytes)
WORDS = Units(True, np.uint64, 8, word_codes)


def _inside(data: bytes, at: int) -> bool:
    """Whether a place lies within a UTF-8 character."""
    return 0 < at < len(data) and data[at] & 0xC0 == 0x80


def whole_characters(data: bytes, first: int, last: int) -> bytes:
    """The piece of ``data`` from one cut to the next, without the parts of characters at its ends."""
    for _ in range(3):  # a character has three continuation bytes at most
        first += _inside(data, first)
        last -= _inside(data, last)
    return data[first:last]


def window_minima(codes: np.ndarray, width: int) -> np.ndarray:
    """Leftmost place of the smallest code in every run of ``width``, by doubling."""
    n = len(codes) - width + 1
    best, at, span = codes, np.arange(len(codes)), 1
    while span < width:
        step = min(span, width - span)
        m = len(best) - step
        later = best[step:] < best[:m]
        at = np.where(later, at[step:], at[:m])
        best = np.minimum(best[step:], best[:m])
        span += step
    return at[:n]


def anchors(data: np.ndarray, length: int, seed: int = SEED) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchor places, the first and last window of each, and hashes of their seeds."""
    codes = mix(PrefixHash(data).all(seed))
    at = window_minima(codes, length - seed + 1)
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    last = np.concatenate([first[1:], [len(at)]]) - 1
    return at[first], first, last, codes[at[first]]


class SuffixSorter:
    """Sorts suffixes of a buffer, as far as ``length`` bytes, within classes."""

    def __init__(self, data: np.ndarray, length: int):
        self.data, self.length = data, length
        self.hashes = PrefixHash(data)

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Common extension of suffix pairs: binary search over prefix hashes."""
        low, high = np.zeros(len(a), dtype=np.int64), np.full(len(a), self.length)
        for _ in range(self.length.bit_length()):
            middle = (low + high + 1) // 2
            same = self.hashes.of(a, middle) == self.hashes.of(b, middle)
            low, high = np.where(same, middle, low), np.where(same, high, np.maximum(low, middle - 1))
        return low

    def less(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        shared = self.common(a, b)
        inside = np.minimum(shared, self.length - 1)
        return (shared < self.length) & (self.data[a + inside] < self.data[b + inside])

    def sort(self, suffixes: np.ndarray, classes: np.ndarray) -> np.ndarray:
        """Suffixes by class and order within it. ``classes`` ascends; all classes merge side by side."""
        out = suffixes.copy()
        begin = np.flatnonzero(np.concatenate([[True], classes[1:] != classes[:-1]]))
        sizes = np.diff(np.concatenate([begin, [len(out)]]))
        own_begin, own_size = np.repeat(begin, sizes), np.repeat(sizes, sizes)
        place = np.arange(len(out)) - own_begin
        run = 1
        while run < (sizes.max() if len(sizes) else 0):
            live = np.flatnonzero(own_size > run)
            block, inner = place[live] // (2 * run), place[live] % (2 * run)
            start = own_begin[live] + block * 2 * run
            middle = np.minimum(start + run, own_begin[live] + own_size[live])
            stop = np.minimum(start + 2 * run, own_begin[live] + own_size[live])
            right = inner >= run
            low, high = np.where(right, start, middle), np.where(right, middle, stop)
            origin, mine = low.copy(), out[live]
            while True:
                open_ = np.flatnonzero(low < high)
                if not len(open_):
                    break
                half = (low[open_] + high[open_]) // 2
                other, own = out[half], mine[open_]
                # equal suffixes keep their order: those of the left run come first
                before = np.where(right[open_], ~self.less(own, other), self.less(other, own))
                low[open_] = np.where(before, half + 1, low[open_])
                high[open_] = np.where(before, high[open_], half)
            moved = out.copy()
            moved[start + (inner - np.where(right, run, 0)) + (low - origin)] = mine
            out = moved
            run *= 2
        return out

    def repeated(self, suffixes: np.ndarray, classes: np.ndarray) -> np.ndarray:
        """The suffixes whose first ``length`` bytes another suffix of their class has too."""
        ordered = self.sort(suffixes, classes)
        a, b = ordered[:-1], ordered[1:]
        same = (classes[1:] == classes[:-1]) & (self.hashes.of(a, self.length) == self.hashes.of(b, self.length))
        found = np.zeros(len(self.data), dtype=bool)
        views = np.lib.stride_tricks.sliding_window_view(self.data, self.length)
        broken = []
        pairs = np.flatnonzero(same)
        for k in range(0, len(pairs), 8192):  # the bytes decide, in slices of bounded size
            x, y = a[pairs[k : k + 8192]], b[pairs[k : k + 8192]]
            equal = (views[x] == views[y]).all(axis=1)
            found[x[equal]] = found[y[equal]] = True
            broken += classes[pairs[k : k + 8192][~equal]].tolist()
        for c in set(broken):  # a collision: this class is settled by its bytes alone
            own = suffixes[classes == c].tolist()
            by_bytes: dict[bytes, list[int]] = {}
            for s in own:
                by_bytes.setdefault(self.data[s : s + self.length].tobytes(), []).append(s)
            found[own] = False
            for group in by_bytes.values():
                found[group] = len(group) > 1
        return suffixes[found[suffixes]]


def repeated_windows(
    seeds: np.ndarray, stretches: list[bytes], before: np.ndarray, length: int, units: Units = BYTES
) -> list[np.ndarray]:
    """For each stretch, the windows (counted from its start) that come in another stretch of its seed.

    ``before`` is the anchor's distance from the start; a window can only equal one with the same distance.
    """
    sizes = np.array([len(s) // units.width for s in stretches])
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    counts = sizes - length + 1
    owner = np.repeat(np.arange(len(sizes)), counts)
    offset = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    suffixes, distance = starts[owner] + offset, before[owner] - offset
    rank = np.unique(seeds, return_inverse=True)[1]
    classes = rank[owner] * (length + 1) + distance
    order = np.argsort(classes, kind="stable")
    sorter = SuffixSorter(np.frombuffer(b"".join(stretches), units.kind), length)
    hits = np.sort(sorter.repeated(suffixes[order], classes[order]))
    at = np.searchsorted(starts, hits, "right") - 1
    bounds = np.searchsorted(at, np.arange(len(sizes) + 1))
    return [hits[bounds[i] : bounds[i + 1]] - starts[i] for i in range(len(sizes))]


def runs(windows: np.ndarray) -> list[tuple[int, int]]:
    """First and last of each run of consecutive numbers."""
    if not len(windows):
        return []
    cut = np.flatnonzero(np.diff(windows) > 1)
    return list(zip(windows[np.concatenate([[0], cut + 1])].tolist(),
                    windows[np.concatenate([cut, [len(windows) - 1]])].tolist(), strict=True))


_ANCHOR = "seed long, digest binary, id long, tag long, anchor int, first int, last int"
_SPAN = "id long, tag long, first int, last int"
_SPAN_SCHEMA = pa.schema([("id", pa.int64()), ("tag", pa.int64()), ("first", pa.int32()), ("last", pa.int32())])


def _span_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * 4
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, _SPAN_SCHEMA, strict=True)], schema=_SPAN_SCHEMA
    )


def _list_anchors(texts: DataFrame, length: int, units: Units) -> DataFrame:
    def run(batches):
        for batch in batches:
            found: list[list] = [[] for _ in range(7)]
            ids, tags = batch.column("id").to_pylist(), batch.column("tag").to_pylist()
            for id_, tag, data in zip(ids, tags, bytes_of(batch.column("text")), strict=True):
                data = units.split(data)
                if len(data) < length:
                    continue
                places, first, last, seeds = anchors(data, length, units.seed)
                ends = last + length
                digests = [
                    hashlib.blake2b(data[a:b], digest_size=16).digest()
                    for a, b in zip(first.tolist(), ends.tolist(), strict=True)
                ]
                for column, values in zip(found, (
                    seeds.view(np.int64), digests, [id_] * len(first), [tag] * len(first), places, first, last
                ), strict=True):
                    column.extend(values if isinstance(values, list) else values.tolist())
            if found[0]:
                kinds = (pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32())
                names = ("seed", "digest", "id", "tag", "anchor", "first", "last")
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(found, kinds, strict=True)], names=list(names)
                )

    return texts.mapInArrow(run, _ANCHOR)


def _fetch(texts: DataFrame, wanted: DataFrame, rules: list[tuple[Units, int]]) -> DataFrame:
    """The bytes or word codes of wanted stretches, one row each."""
    by_words = {units.words: (units, length) for units, length in rules}
    listed = wanted.groupBy("id", "tag").agg(
        F.collect_set(F.struct("seed", "anchor", "first", "last", "hot", "words")).alias("stretches")
    )
    joined = _same_row(texts, listed, "inner").select(texts["id"], texts["tag"], "text", "stretches")

    def run(batches):
        last = None
        for batch in batches:
            rows: list[tuple] = []
            held = 0
            columns = [batch.column(n).to_pylist() for n in ("id", "tag", "stretches")]
            for id_, tag, stretches, data in zip(*columns, bytes_of(batch.column("text")), strict=True):
                if (id_, tag) == last:
                    continue  # repeated rows come one after the other, and one stands for all
                last = id_, tag
                split = {kind: by_words[kind][0].split(data) for kind in {s["words"] for s in stretches}}
                for s in stretches:
                    part = split[s["words"]][s["first"] : s["last"] + by_words[s["words"]][1]].tobytes()
                    rows.append((
                        s["seed"], id_, tag, s["anchor"] - s["first"], s["first"], part, s["hot"], s["words"],
                    ))
                    held += len(part)
                if held > 16 << 20:
                    yield _stretch_batch(rows)
                    rows, held = [], 0
            if rows:
                yield _stretch_batch(rows)

    return joined.mapInArrow(run, _STRETCH)


_STRETCH = "seed long, id long, tag long, before int, first int, data binary, hot boolean, words boolean"


def _stretch_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.bool_(), pa.bool_())
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
        names=["seed", "id", "tag", "before", "first", "data", "hot", "words"],
    )


def _sort_groups(stretches: DataFrame, length: int, units: Units) -> DataFrame:
    """Spans of repeated windows, the stretches of a seed being sorted in one task."""
    ordered = stretches.repartition("seed").sortWithinPartitions("seed")

    def settle(rows: list[tuple]) -> pa.RecordBatch:
        seeds = np.array([r[0] for r in rows])
        found = repeated_windows(seeds, [r[5] for r in rows], np.array([r[3] for r in rows]), length, units)
        return _span_batch([
            (r[1], r[2], r[4] + a, r[4] + b) for r, hits in zip(rows, found, strict=True) for a, b in runs(hits)
        ])

    def run(batches):
        held: list[tuple] = []
        windows = 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if windows > CHUNK_WINDOWS and held[-1][0] != row[0]:
                    yield settle(held)
                    held, windows = [], 0
                held.append(row)
                windows += len(row[5]) // units.width - length + 1
        if held:
            yield settle(held)

    return ordered.mapInArrow(run, _SPAN)


def _count_windows(stretches: DataFrame, length: int, units: Units) -> DataFrame:
    """The same for seeds with too many stretches to gather: a row per window, counted by digest."""

    def run(batches):
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                _, id_, tag, _, first, data, *_ = row
                data = np.frombuffer(data, units.kind)
                n = len(data) - length + 1
                yield pa.RecordBatch.from_pydict({
                    "digest": [hashlib.blake2b(data[i : i + length], digest_size=16).digest() for i in range(n)],
                    "id": pa.array([id_] * n, pa.int64()), "tag": pa.array([tag] * n, pa.int64()),
                    "first": pa.array(range(first, first + n), pa.int32()),
                })

    windows = stretches.mapInArrow(run, "digest binary, id long, tag long, first int")
    many = windows.groupBy("digest").agg(F.count("*").alias("n")).where("n > 1")
    return windows.join(many, "digest").select("id", "tag", "first", F.col("first").alias("last"))


def _same_row(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    return left.join(right, left["id"].eqNullSafe(right["id"]) & (left["tag"] == right["tag"]), how)


def row_tag(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def _by_seed(texts: DataFrame, length: int, group: int, units: Units, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Spans that are settled without a sort, and the stretches that need one."""
    listed = _list_anchors(texts, length, units)
    if units.words:  # words are cheap to list twice, and few of their seeds repeat
        listed = listed.join(listed.groupBy("seed").count().where("count > 1").select("seed"), "seed", "left_semi")
    listed = scratch.stage(listed, "anchors")
    whole = listed.groupBy("seed", "digest").agg(
        F.count("*").alias("copies"), F.min(F.struct("id", "tag", "anchor", "first", "last")).alias("one")
    )
    whole = scratch.stage(whole, "stretches")
    scratch.release()
    seeds = whole.groupBy("seed").agg(
        F.sum("copies").alias("all_copies"), F.count("*").alias("kinds"),
        F.count(F.when(F.col("copies") == 1, 1)).alias("singles"),
    ).where("all_copies > 1")
    settled = listed.join(whole.where("copies > 1").select("digest"), "digest").select("id", "tag", "first", "last")
    # of mixed seeds, one stretch of each kind is sorted; kinds with copies only serve as partners
    mixed = seeds.where("singles > 0 and kinds > 1").select("seed", (F.col("kinds") > group).alias("hot"))
    return settled, whole.join(mixed, "seed").select("seed", "one.*", "hot", F.lit(units.words).alias("words"))


def repeated_spans(
    docs: DataFrame, length: int = 400, key: str = "doc_id", text: str = "text", group: int = GROUP, words: int | None = None,
) -> DataFrame:
    """(id, tag, first, last, words): runs of windows that repeat, per row; they may overlap.

    Places are counted in bytes, or in words where ``words`` is true.
    """
    texts = docs.select(F.col(key).cast("long").alias("id"), row_tag(F.col(text)).alias("tag"), F.col(text).alias("text"))
    rules = [(BYTES, length), *([(WORDS, words)] if words else [])]
    scratch = Scratch(docs.sparkSession, "spans")
    settled, wanted = zip(*(_by_seed(texts, size, group, units, scratch) for units, size in rules), strict=True)
    stretches = scratch.stage(_fetch(texts, reduce(DataFrame.unionByName, wanted), rules), "fetched")
    scratch.release()
    spans = []
    for (units, size), done in zip(rules, settled, strict=True):
        own = stretches.where(F.col("words") == units.words)
        near = _sort_groups(own.where("not hot"), size, units)
        found = done.unionByName(near).unionByName(_count_windows(own.where("hot"), size, units))
        spans.append(found.withColumn("words", F.lit(units.words)))
    return scratch.result(reduce(DataFrame.unionByName, spans).distinct())


def drop_repeated(
    docs: DataFrame, length: int = 400, key: str = "doc_id", text: str = "text", group: int = GROUP, words: int | None = None,
) -> DataFrame:
    """All rows and columns, with n_bytes, n_removed, n_spans, the bytes that are left as ``kept``, and ``kept_text``.

    What goes is in a repeated string of ``length`` bytes or, if given, in a repeated passage of ``words`` words, 8 at least.
    Where a cut falls inside a character, its other part is missing in ``kept_text`` too; nothing else differs from ``kept``.
    Input columns with the names of the added ones are replaced; pack them in a struct to keep them.
    """
    if words is not None and words < WORDS.seed:
        raise ValueError(f"passages need {WORDS.seed} words at least")
    # a set: n rows of one id and text found the same spans n times
    spans = repeated_spans(docs, length, key, text, group, words).groupBy("id", "tag").agg(
        F.collect_set(F.struct("first", "last", "words")).alias("_spans")
    )
    added = ("n_bytes", "n_removed", "n_spans", "kept", "kept_text")
    base = docs.drop(*added)
    left = base.select(
        F.struct(*[base[f"`{c}`"] for c in base.columns]).alias("_row"), F.col(text).cast("binary").alias("_data"),
        F.col(key).cast("long").alias("id"), row_tag(F.col(text)).alias("tag"),
    )
    joined = _same_row(left, spans, "left").select("_row", "_data", "_spans")

    def in_bytes(whole: bytes, found: list[dict]) -> list[tuple[int, int]]:
        spans = [(s["first"], s["last"] + length) for s in found if not s["words"]]
        if len(spans) < len(found):
            starts, ends = word_bounds(whole)
            spans += [(int(starts[s["first"]]), int(ends[s["last"] + words - 1])) for s in found if s["words"]]
        return spans

    @F.arrow_udf("n_bytes long, n_removed long, n_spans long, kept binary, kept_text binary")
    def cut(data: pa.Array, spans: pa.Array) -> pa.Array:
        out: list[list] = [[], [], [], [], []]
        for whole, found in zip(data.to_pylist(), spans.to_pylist(), strict=True):
            whole = whole or b""
            kept, at, removed, n = [], 0, 0, 0
            reach = -1
            for first, last in sorted(in_bytes(whole, found or [])):
                if first > reach:
                    n += 1
                    kept.append((at, first))
                    at = reach = first
                if last > reach:
                    removed += last - reach
                    at = reach = last
            kept.append((at, len(whole)))
            parts = b"".join([whole[a:b] for a, b in kept])
            text = b"".join([whole_characters(whole, a, b) for a, b in kept])
            for column, value in zip(out, (len(whole), removed, n, parts, text), strict=True):
                column.append(value)
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary())
        return pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names=list(added))

    done = joined.select("_row", cut("_data", "_spans").alias("_cut")).select("_row.*", "_cut.*")
    return done.withColumn("kept_text", F.col("kept_text").cast("string"))
