"""Bootstrap intervals with a fixed number of draws per group.

A replicate draws as many rows as a group has, with replacement. The rows of a group are numbered and cut into blocks. How many
of a replicate's draws fall into a block follows from a splitting tree: a node's draws are divided between its halves by a
binomial whose seed is the node's own, so a block finds its share by walking from the root, knowing nothing but the size of
its group. The weights of a replicate therefore add up to the group's size exactly, though no task sees more than a
block. Inside the block the draws are spread evenly over its rows.

Every draw depends on group, replicate, node and block alone: a repeated task draws alike.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.bootstrap import LEHMER_FACTOR, LEHMER_PRIME
from tidemark.operators.series import numbered
from tidemark.session import settle, stage

BLOCK = 4096
# Draws up to which a binomial is read off its distribution function; beyond that numpy samples it, seeded by the node.
SMALL = 2048
# Distribution functions tabulated at a time; a bound of memory only.
SIZES_AT_ONCE = 64
# Rows of a group that one task walks through; a larger group is walked by several.
STRETCH = 1 << 16
BROADCAST_GROUPS = 100_000


def _digest(*parts) -> int:
    return int(hashlib.md5("|".join(map(str, parts)).encode()).hexdigest(), 16)


def _digests(name: str, count: int) -> np.ndarray:
    """The first 64 bits of the digests of ``name|0``, ``name|1``, ..."""
    begun = hashlib.md5(f"{name}|".encode())

    def of(b: int) -> bytes:
        whole = begun.copy()
        whole.update(b"%d" % b)
        return whole.digest()[:8]

    return np.frombuffer(b"".join(map(of, range(count))), ">u8").astype(np.uint64)


@lru_cache(maxsize=1)
def _log_factorials() -> np.ndarray:
    return np.concatenate([[0.0], np.cumsum(np.log(np.arange(1, SMALL + 1)))])


def binomials(draws: np.ndarray, share: float, node: str) -> np.ndarray:
    """Of each replicate's draws, how many fall into the left half of a node that holds ``share`` of its rows."""
    if share >= 1:
        return draws.copy()
    logs, few = _log_factorials(), draws <= SMALL
    out = np.zeros(len(draws), dtype=np.int64)
    if not few.all():
        out = np.random.Generator(np.random.Philox(key=_digest("node", node))).binomial(draws, share)
    if few.any():
        u = (_digests(f"split|{node}", len(draws)) >> np.uint64(12)) / 2.0**52
        places = np.flatnonzero(few)
        places = places[np.argsort(draws[places], kind="stable")]
        sizes, firsts = np.unique(draws[places], return_index=True)
        ends = np.append(firsts[1:], len(places))
        for at in range(0, len(sizes), SIZES_AT_ONCE):  # a row per size: its distribution function
            k = sizes[at : at + SIZES_AT_ONCE, None]
            x = np.arange(k.max())
            left = np.maximum(k - x, 0)
            chance = np.exp(logs[k] - logs[x] - logs[left] + x * np.log(share) + left * np.log1p(-share))
            below = np.cumsum(np.where(x < k, chance, np.inf), axis=1)
            for steps, first, end in zip(below, firsts[at:].tolist(), ends[at:].tolist()):
                out[places[first:end]] = steps.searchsorted(u[places[first:end]], side="right")
    return out


class Tree:
    """The splitting tree of one group, walked from block to block; a node on the way to the next block isn't drawn again."""

    def __init__(self, label: str, n: int, block: int, replicates: int):
        self.label, self.n, self.block = label, n, block
        self.path = [(0, -(-n // block), np.full(replicates, n, dtype=np.int64))]

    def draws(self, at: int) -> np.ndarray:
        """Draws that fall into block ``at``, per replicate."""
        while not self.path[-1][0] <= at < self.path[-1][1]:
            self.path.pop()
        low, high, draws = self.path[-1]
        while high - low > 1:
            middle = (low + high) // 2
            share = (middle - low) * self.block / (min(high * self.block, self.n) - low * self.block)
            left = binomials(draws, share, f"{self.label}|{low}|{high}")
            halves = (low, middle, left), (middle, high, draws - left)
            # the right half waits below the left one, as it comes next
            self.path[-1] = halves[1]
            if at < middle:
                self.path.append(halves[0])
            low, high, draws = self.path[-1]
        return draws


def block_draws(label: str, n: int, at: int, block: int, replicates: int) -> np.ndarray:
    """Draws that fall into block ``at`` of a group of ``n`` rows, per replicate."""
    return Tree(label, n, block, replicates).draws(at)


@lru_cache(maxsize=4)
def _factors(count: int) -> np.ndarray:
    found = [LEHMER_FACTOR]
    while len(found) < count:
        found.append(found[-1] * LEHMER_FACTOR % LEHMER_PRIME)
    return np.array(found, dtype=np.int64)


def block_weights(label: str, at: int, size: int, draws: np.ndarray) -> np.ndarray:
    """replicates x rows: how often each row of a block is drawn."""
    most = int(draws.max(initial=0))
    seeds = (_digests(f"draw|{label}|{at}", len(draws)) >> np.uint64(32)).astype(np.int64) % (LEHMER_PRIME - 1) + 1
    factors = _factors(1 << max(most - 1, 1).bit_length())[:most]
    places = seeds[:, None] * factors % LEHMER_PRIME * size // LEHMER_PRIME
    places += np.arange(len(draws))[:, None] * size
    drawn = places[np.arange(most) < draws[:, None]]
    return np.bincount(drawn, minlength=len(draws) * size).reshape(len(draws), size)


def _label(column: str, kind: T.DataType) -> Column:
    value = F.unix_micros(F.col(column)) if isinstance(kind, T.TimestampType) else F.col(column)
    return F.coalesce(value.cast("string"), F.lit("null"))


def placed_rows(rows: DataFrame, groups: Sequence[str], key: Sequence[str]) -> DataFrame:
    """The groups and values of ``rows`` with ``_i``, a row's place in its group, and ``_n``, the group's size.

    Rows are numbered over all groups by a range-partitioned sort; a group starts at its smallest number. The place in
    the scan comes last in the order, so that equal rows don't keep a range together.
    """
    valued = rows.where(F.col("_x").isNotNull()).select(*groups, *key, F.col("_x").cast("double").alias("_x"))
    valued = valued.withColumn("_scan", F.monotonically_increasing_id())
    placed = numbered(valued, list(dict.fromkeys([*groups, *key, "_x", "_scan"])))
    starts = stage(placed.groupBy(*groups).agg(F.min("_index").alias("_start"), F.count("*").alias("_n")), "groups")
    named = starts.select(*[F.col(g).alias(f"_g{i}") for i, g in enumerate(groups)], "_start", "_n")
    few = starts.limit(BROADCAST_GROUPS + 1).count() <= BROADCAST_GROUPS  # beyond that AQE splits a large group
    same = F.lit(True)
    for i, g in enumerate(groups):
        same &= F.col(g).eqNullSafe(F.col(f"_g{i}"))
    joined = placed.join(F.broadcast(named) if few else named, same)
    return joined.select(*groups, "_x", (F.col("_index") - F.col("_start")).alias("_i"), "_n")


def _stretch(block: int) -> int:
    """Blocks that one task walks through in a group."""
    return max(STRETCH // block, 1)


class _Drawn:
    """Sums of the drawn values of one stretch of blocks; rows come in order and in pieces of any size."""

    def __init__(self, groups: list[pa.Array], label: str, n: int, block: int, replicates: int):
        self.groups, self.label, self.n, self.block = groups, label, n, block
        self.tree = Tree(label, n, block, replicates)
        self.held, self.first = np.zeros(0), None
        self.w, self.wx = np.zeros(replicates, dtype=np.int64), np.zeros(replicates)

    def add(self, first: int, values: np.ndarray) -> None:
        self.first = first if self.first is None else self.first
        self.held = np.concatenate([self.held, values]) if len(self.held) else values
        at = 0
        while len(self.held) - at >= (size := min(self.block, self.n - self.first)) > 0:
            own = self.held[at : at + size]
            number = self.first // self.block
            weights = block_weights(self.label, number, size, self.tree.draws(number))
            self.w += weights.sum(axis=1)
            self.wx += weights @ own
            at, self.first = at + size, self.first + size
        self.held = self.held[at:]


def replicate_sums(placed: DataFrame, groups: Sequence[str], replicates: int, block: int) -> DataFrame:
    """Per group and replicate: the sum of the drawn values. A task holds one block at a time.

    A task walks through stretches of blocks in order, so that neighbouring blocks share their way down the tree, and sends
    on one row per replicate and stretch.
    """
    label = F.concat_ws("|", *[_label(g, placed.schema[g].dataType) for g in groups])
    stretch = F.floor(F.col("_i") / (block * _stretch(block)))
    rows = placed.select(*groups, label.alias("_label"), stretch.alias("_stretch"), "_i", "_n", F.col("_x").cast("double").alias("_x"))
    rows = rows.repartition(*groups, "_stretch").sortWithinPartitions(*groups, "_i")
    schema = T.StructType([
        *[placed.schema[g] for g in groups], T.StructField("_b", T.IntegerType()), T.StructField("_w", T.LongType()),
        T.StructField("_wx", T.DoubleType()),
    ])

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drawn, last = None, (-1, -1)

        def sums() -> pa.RecordBatch:
            first = pa.array(np.zeros(replicates, dtype=np.int64))
            return pa.RecordBatch.from_arrays([
                *[g.take(first) for g in drawn.groups], pa.array(np.arange(replicates, dtype=np.int32)), pa.array(drawn.w), pa.array(drawn.wx),
            ], names=[*groups, "_b", "_w", "_wx"])

        for batch in batches:
            if not batch.num_rows:
                continue
            at, places, values = (batch.column(c).to_numpy() for c in ("_stretch", "_i", "_x"))
            # the next place of the same stretch is always the same group's
            goes_on = (np.diff(at, prepend=last[0]) == 0) & (np.diff(places, prepend=last[1]) == 1)
            last = int(at[-1]), int(places[-1])
            cuts = np.unique(np.concatenate([[0], np.flatnonzero(~goes_on), [batch.num_rows]]))
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                if not goes_on[a]:
                    if drawn is not None:
                        yield sums()
                    label, n = (batch.column(c)[a].as_py() for c in ("_label", "_n"))
                    drawn = _Drawn([batch.column(g).slice(a, 1) for g in groups], label, n, block, replicates)
                drawn.add(int(places[a]), values[a:b])
        if drawn is not None:
            yield sums()

    return rows.mapInArrow(draw, schema).groupBy(*groups, "_b").agg(F.sum("_w").alias("_w"), F.sum("_wx").alias("_wx"))


def resampled_intervals(
    rows: DataFrame, groups: Sequence[str], key: Sequence[str], replicates: int = 200, alpha: float = 0.05, block: int = BLOCK,
) -> DataFrame:
    """Mean, count and interval of ``_x`` per group. Rows without a value are not drawn; a group of such rows has count 0."""
    rows = rows.select(*dict.fromkeys([*groups, *key]), "_x")
    plain = rows.groupBy(*groups).agg(F.avg(F.col("_x").cast("double")).alias("signal"), F.count("_x").alias("n"))
    sums = replicate_sums(placed_rows(rows, groups, key), groups, replicates, block)
    ends = sums.groupBy(*groups).agg(F.percentile(F.col("_wx") / F.col("_w"), [alpha / 2, 1 - alpha / 2]).alias("_ends"))
    ends = settle(ends.select(*[F.col(g).alias(f"_g{i}") for i, g in enumerate(groups)], "_ends"))
    same = F.lit(True)
    for i, g in enumerate(groups):
        same &= F.col(g).eqNullSafe(F.col(f"_g{i}"))
    return plain.join(ends, same, "left").select(
        *groups, "signal", "n", F.col("_ends")[0].alias("ci_lo"), F.col("_ends")[1].alias("ci_hi")
    )
