"""Bootstrap intervals of a mean, per group.

Every row is weighed by a Poisson(1) count per replicate instead of
drawing row numbers. Weights depend on the row's key alone, so a lost task
repeats them exactly, and the sums of a group add up over partitions: tasks add up a
matrix of groups x replicates from whole batches and send its cells, however many rows a group has.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The 31-bit Lehmer generator ("minimal standard").
LEHMER_PRIME = 2_147_483_647
LEHMER_FACTOR = 48_271

# Rows weighed at a time and groups summed before they are sent on; bounds of a task's memory only.
SLICE = 4096
HELD_GROUPS = 4096


def multipliers(replicates: int) -> list[int]:
    """Draw b of a generator is its seed times this number, modulo the prime."""
    return [pow(LEHMER_FACTOR, b + 1, LEHMER_PRIME) for b in range(replicates)]


def poisson_steps() -> list[int]:
    """Draws above the k-th step weigh more than k: the Poisson(1) distribution on 31 bits."""
    steps, total = [], 0.0
    for k in range(12):
        total += math.exp(-1) / math.factorial(k)
        steps.append(int(LEHMER_PRIME * total))
    return steps


def row_seed(key: Sequence[str]) -> Column:
    """A generator seed in 1..prime-1 from the key columns."""
    digest = F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in key]))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % (LEHMER_PRIME - 1) + 1


def poisson_weights(draws: np.ndarray) -> np.ndarray:
    """The weight of each draw: how many steps it lies above."""
    return np.searchsorted(poisson_steps(), draws, side="left")


def _group_numbers(batch: pa.RecordBatch, width: int) -> tuple[np.ndarray, list[tuple]]:
    """The group of every row and the groups' keys, from the first ``width`` columns."""
    if not width:
        return np.zeros(batch.num_rows, dtype=np.int64), [()]
    coded = [batch.column(i).dictionary_encode("encode") for i in range(width)]
    codes = np.column_stack([c.indices.to_numpy(zero_copy_only=False) for c in coded])
    distinct, numbers = np.unique(codes, axis=0, return_inverse=True)
    values = [c.dictionary.to_pylist() for c in coded]
    return numbers.ravel(), [tuple(v[i] for v, i in zip(values, row)) for row in distinct]


def replicate_sums(
    rows: DataFrame, groups: Sequence[str], key: Sequence[str], replicates: int
) -> DataFrame:
    """Per group and replicate: sum of weights and of weighted values.

    Replicate -1 has weight 1 for every row; it carries the plain mean and count
    so that the rows are read once. Rows without a value weigh nothing.
    """
    factors = np.array(multipliers(replicates), dtype=np.int64)
    seeded = rows.select(*groups, F.col("_x").cast("double").alias("_x"), row_seed(key).alias("_seed"))
    kinds = [T.StructField(g, seeded.schema[g].dataType) for g in groups]
    sums = [T.StructField("_b", T.IntegerType()), T.StructField("_w", T.LongType()), T.StructField("_wx", T.DoubleType())]
    width = len(kinds)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, np.ndarray] = {}
        types: list[pa.DataType] = []

        def cells() -> pa.RecordBatch:
            keys, table = list(held), np.stack(list(held.values()))
            weights, products = table[:, 0].ravel(), table[:, 1].ravel()
            used = (weights > 0) | (np.tile(np.arange(replicates + 1), len(keys)) == 0)
            owner = np.repeat(np.arange(len(keys)), replicates + 1)[used]
            columns = [pa.array([k[i] for k in keys], kind).take(pa.array(owner)) for i, kind in enumerate(types)]
            number = np.tile(np.arange(-1, replicates), len(keys))[used]
            return pa.RecordBatch.from_arrays(
                [*columns, pa.array(number, pa.int32()), pa.array(weights[used].astype(np.int64)), pa.array(products[used])],
                names=[*groups, "_b", "_w", "_wx"],
            )

        for whole in batches:
            types = [whole.schema.field(i).type for i in range(width)]
            for start in range(0, whole.num_rows, SLICE):
                batch = whole.slice(start, SLICE)
                numbers, keys = _group_numbers(batch, width)
                x = batch.column(width).to_numpy(zero_copy_only=False).astype(float)
                seeds = batch.column(width + 1).to_numpy(zero_copy_only=False)
                weights = np.ones((len(x), replicates + 1))
                weights[:, 1:] = poisson_weights(seeds[:, None] * factors % LEHMER_PRIME)
                valued = batch.column(width).is_valid().to_numpy(zero_copy_only=False)
                weights[~valued] = 0
                order = np.argsort(numbers, kind="stable")
                starts = np.searchsorted(numbers[order], np.arange(len(keys)))
                weighted = weights * np.where(valued, x, 0.0)[:, None]
                for k, w, wx in zip(keys, np.add.reduceat(weights[order], starts), np.add.reduceat(weighted[order], starts)):
                    held[k] = held[k] + (w, wx) if k in held else np.stack([w, wx])
                if len(held) > HELD_GROUPS:
                    yield cells()
                    held = {}
        if held:
            yield cells()

    return seeded.mapInArrow(add, T.StructType([*kinds, *sums])).groupBy(*groups, "_b").agg(
        F.sum("_w").alias("_w"), F.sum("_wx").alias("_wx")
    )


def poisson_intervals(
    rows: DataFrame,
    groups: Sequence[str],
    key: Sequence[str],
    replicates: int = 200,
    alpha: float = 0.05,
) -> DataFrame:
    """Mean, count and interval of ``_x`` per group."""
    plain = F.col("_b") == -1
    mean = F.when(F.col("_w") > 0, F.col("_wx") / F.col("_w"))
    ends = F.percentile(F.when(~plain, mean), [alpha / 2, 1 - alpha / 2])
    return (
        replicate_sums(rows, groups, key, replicates)
        .groupBy(*groups)
        .agg(
            F.max(F.when(plain, mean)).alias("signal"),
            F.max(F.when(plain, F.col("_w"))).alias("n"),
            ends.alias("_ends"),
        )
        .select(*groups, "signal", "n", F.col("_ends")[0].alias("ci_lo"), F.col("_ends")[1].alias("ci_hi"))
    )
