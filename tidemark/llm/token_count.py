"""Token counts of a byte-level BPE without making ids.

A piece starts as one symbol per byte in a linked list. A heap gives the lowest-ranked adjacent pair,
leftmost first; each merge removes one symbol, so the count is the initial symbols less the merges.

Defined results: a null or empty text has no tokens. Strings of special tokens inside a text count one each, as the
library does by default. Runs of any length take n log n steps.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.llm.common import texts_of

# The pattern of the byte-level splitter.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
CACHED_PIECES = 250_000


def byte_letters() -> list[str]:
    """The letter that stands for each byte: printable ones themselves, the others from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(256))
    return [chr(b if b in plain else 256 + next(others)) for b in range(256)]


class Counter:
    def __init__(self, vocab: dict[str, int], merges: list, special: list[str]):
        self.start = [vocab[c] for c in byte_letters()]
        self.ranks = {}
        for rank, pair in enumerate(merges):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.ranks.setdefault((vocab[a], vocab[b]), (rank, vocab[a + b]))
        self.pattern = regex.compile(SPLIT)
        names = "|".join(regex.escape(s) for s in sorted(special, key=len, reverse=True))
        self.special = regex.compile(names) if names else None
        self.known: dict[str, int] = {}

    def piece(self, text: str) -> int:
        symbols = [self.start[b] for b in text.encode("utf-8", "surrogatepass")]
        size, merged = len(symbols), 0
        after, before = list(range(1, size + 1)), list(range(-1, size - 1))
        ranks, heap = self.ranks, []
        for i in range(size - 1):
            if found := ranks.get((symbols[i], symbols[i + 1])):
                heap.append((found[0], i, symbols[i], symbols[i + 1], found[1]))
        heapq.heapify(heap)
        while heap:
            _, i, a, b, made = heapq.heappop(heap)
            j = after[i]
            if symbols[i] != a or j >= size or symbols[j] != b:
                continue  # one of the two has gone into another merge
            symbols[i], symbols[j] = made, -1
            after[i] = after[j]
            if after[j] < size:
                before[after[j]] = i
            merged += 1
            for x in (before[i], i):  # the new symbol has a pair on either side
                if x >= 0 and (y := after[x]) < size and (found := ranks.get((symbols[x], symbols[y]))):
                    heapq.heappush(heap, (found[0], x, symbols[x], symbols[y], found[1]))
        return size - merged

    def plain(self, text: str) -> int:
        known = self.known
        if len(known) > CACHED_PIECES:
            known.clear()
        pieces = self.pattern.findall(text)
        try:
            return sum([known[p] for p in pieces])
        except KeyError:
            for p in set(pieces):
                if p not in known:
                    known[p] = self.piece(p)
            return sum([known[p] for p in pieces])

    def count(self, text: str) -> int:
        if self.special is None:
            return self.plain(text)
        parts = self.special.split(text)
        return len(parts) - 1 + sum(self.plain(p) for p in parts)


@lru_cache(maxsize=4)
def load(path: str) -> Counter:
    with open(path, encoding="utf-8") as file:
        data = json.load(file)
    splitter = data["pre_tokenizer"] or {}
    model = data["model"]
    if model["type"] != "BPE" or splitter.get("type") != "ByteLevel" or data["normalizer"]:
        raise ValueError(f"{path} is not a plain byte-level BPE")
    if splitter["add_prefix_space"] or not splitter["use_regex"] or model.get("ignore_merges"):
        raise ValueError(f"{path} has options that are not supported")
    return Counter(model["vocab"], model["merges"], [t["content"] for t in data["added_tokens"]])


def count_tokens(text: Column, path: str) -> Column:
    """Tokens of every whole text. ``path`` names a tokenizer file that every worker has."""

    @F.arrow_udf("long")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        counter = load(path)
        for values in batches:
            yield pa.array([counter.count(t) for t in texts_of(values)], pa.int64())
        counter.known.clear()  # workers live on for tasks of other kinds

    return run(text)
