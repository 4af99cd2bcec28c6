"""Byte-level BPE as a tree reduction over encoded pieces.

Encoded byte strings form a monoid: joining two encodings re-encodes a window around the seam and
widens it until the tokens at both edges go together with their outer neighbours. Two tokens
go together if encoding their joined bytes gives just these two. A sequence whose neighbours all go
together is the encoding of its bytes, so everything outside the window is settled. A long piece
is halved down to short leaves and joined up the tree; decoding joins token bytes the same way.

Defined results: a null or empty text has no ids. Very long runs without a break are fine, as no step
looks at more than the window. Repeated pieces are looked up, with a bounded table per worker.
"""

from __future__ import annotations

import base64
import heapq
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.llm.common import texts_of, trim

LEAF = 32
NONE = 1 << 32
CACHED_PIECES = 250_000


def direct(data: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Encode by merging the lowest-ranked neighbours, leftmost first."""
    if len(data) > 2 * LEAF:
        return _direct_long(data, ranks)
    parts = [data[i : i + 1] for i in range(len(data))]
    get = ranks.get
    pairs = [get(a + b, NONE) for a, b in zip(parts, parts[1:])]
    while pairs and (best := min(pairs)) != NONE:
        at = pairs.index(best)
        parts[at] += parts.pop(at + 1)
        del pairs[at]
        if at:
            pairs[at - 1] = get(parts[at - 1] + parts[at], NONE)
        if at < len(pairs):
            pairs[at] = get(parts[at] + parts[at + 1], NONE)
    return [ranks[p] for p in parts]


def _direct_long(data: bytes, ranks: dict[bytes, int]) -> list[int]:
    size = len(data)
    end, back = list(range(1, size + 1)), list(range(-1, size - 1))

    def offer(i: int) -> None:
        if end[i] < size:
            rank = ranks.get(data[i : end[end[i]]])
            if rank is not None:
                heapq.heappush(heap, (rank, i, end[end[i]]))

    heap: list[tuple[int, int, int]] = []
    for i in range(size - 1):
        offer(i)
    gone = bytearray(size)
    while heap:
        _, i, stop = heapq.heappop(heap)
        if gone[i] or end[i] >= stop or end[i] == size or end[end[i]] != stop:
            continue
        gone[end[i]] = 1
        end[i] = stop
        if stop < size:
            back[stop] = i
        offer(i)
        if back[i] >= 0:
            offer(back[i])
    out, i = [], 0
    while i < size:
        out.append(ranks[data[i : end[i]]])
        i = end[i]
    return out


class Codec:
    """Rank table of a byte-level BPE with the pattern that splits texts into pieces."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.token = {rank: data for data, rank in ranks.items()}
        self.pattern = regex.compile(pattern)
        self._together: dict[tuple[int, int], bool] = {}
        self._pieces: dict[str, bytes] = {}

    def forget(self) -> None:
        """Give back what was looked up: workers live on for tasks of other kinds."""
        self._together.clear()
        self._pieces.clear()

    def together(self, a: int, b: int) -> bool:
        known = self._together.get((a, b))
        if known is None:
            if len(self._together) > CACHED_PIECES // 4:
                self._together.clear()
            known = direct(self.token[a] + self.token[b], self.ranks) == [a, b]
            self._together[a, b] = known
        return known

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """Encoding of the bytes of two encodings put together."""
        if not left or not right:
            return left or right
        i = j = 1
        while True:
            window = left[len(left) - i :] + right[:j]
            inner = direct(b"".join(self.token[t] for t in window), self.ranks)
            good_left = i == len(left) or self.together(left[-i - 1], inner[0])
            good_right = j == len(right) or self.together(inner[-1], right[j])
            if good_left and good_right:
                return left[: len(left) - i] + inner + right[j:]
            i = i if good_left else min(len(left), 2 * i)
            j = j if good_right else min(len(right), 2 * j)

    def tree(self, data: bytes) -> list[int]:
        if len(data) <= LEAF:
            return direct(data, self.ranks)
        middle = len(data) // 2
        return self.join(self.tree(data[:middle]), self.tree(data[middle:]))

    def piece(self, text: str) -> bytes:
        data = text.encode("utf-8", "surrogatepass")
        whole = self.ranks.get(data)
        ids = self.tree(data) if whole is None else [whole]
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        known = self._pieces
        if len(known) > CACHED_PIECES:
            known.clear()
        pieces = self.pattern.findall(text)
        try:
            return b"".join([known[p] for p in pieces])
        except KeyError:
            for p in set(pieces):
                if p not in known:
                    known[p] = self.piece(p)
            return b"".join([known[p] for p in pieces])

    def decode(self, ids: bytes) -> bytes:
        """Bytes of the tokens, joined pairwise up the tree."""
        parts = [self.token[t] for t in np.frombuffer(ids, dtype="<u4").tolist()]
        while len(parts) > 1024:
            parts = [b"".join(parts[i : i + 1024]) for i in range(0, len(parts), 1024)]
        return b"".join(parts)


@lru_cache(maxsize=4)
def load(path: str, pattern: str) -> Codec:
    with open(path, "rb") as lines:
        pairs = (line.split() for line in lines if line.strip())
        return Codec({base64.b64decode(a): int(b) for a, b in pairs}, pattern)


def encode(text: Column, path: str, pattern: str) -> Column:
    """Ids of every whole text as binary, four little-endian bytes per id.

    ``path`` names a rank file that every worker has.
    """

    @F.arrow_udf("binary")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        codec = load(path, pattern)
        for values in batches:
            yield pa.array([codec.encode(t) for t in texts_of(values)], pa.binary())
        codec.forget()
        trim()

    return run(text)


def round_trip(text: Column, path: str, pattern: str) -> Column:
    """Struct of the ids of every whole text and the bytes that they decode to, by one worker per task."""

    @F.arrow_udf("ids binary, data binary")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        codec = load(path, pattern)
        for values in batches:
            ids = [codec.encode(t) for t in texts_of(values)]
            data = [codec.decode(i) for i in ids]
            yield pa.StructArray.from_arrays([pa.array(ids, pa.binary()), pa.array(data, pa.binary())], names=["ids", "data"])
        codec.forget()
        trim()

    return run(text)


def decode(ids: Column, path: str, pattern: str) -> Column:
    """Bytes that the ids stand for."""

    @F.arrow_udf("binary")
    def run(values: pa.Array) -> pa.Array:
        codec = load(path, pattern)
        return pa.array([codec.decode(v or b"") for v in values.to_pylist()], pa.binary())

    return run(ids)
