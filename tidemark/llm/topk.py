"""Exact top-k by inner product, aggregating sorted lists without random access.

Vectors are taken in blocks. Each dimension of a block is a list sorted by value, read from the top for queries with a
positive component and from the bottom for those with a negative one. After a number of
entries, what was read and the last entry of each list bound every score from above and below. A query stops
reading a block when no vector outside a few can reach its k-th best lower bound, or the
k-th score found in earlier blocks; the scores of those few are then resolved. Bounds of all queries and vectors
of a block at one depth come from matrix products.

Blocks are written once, below the shared folder, and named in a small table. A cell of the grid is a group of query blocks and a
slice of vector blocks: its task holds the queries, reads one vector block after another and returns k rows per query, so no
vector travels more than once however many queries there are, and no task holds more than a group of queries and a block.
There are at most ``SLICES`` slices, so what is ranked in the end grows with the queries alone.

Defined results: vectors that are null or hold null or non-finite components take no part, nor do rows without an id. A
candidate has as many components as the query and another id. Equal scores go to the smaller id. Rows with equal ids and
vectors count once. Different vectors under one id stay apart: each is a candidate, and as queries each has ranks of its own. Other
columns aren't read; an empty table has no results. With fewer than k candidates all are returned. Scores must fit 64 bits.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import open_store, shared_uri, write_once
from tidemark.session import MAX_PARTITIONS, stage

QUERY_BLOCK = 512
VECTOR_BLOCK = 4096
GROUP_BLOCKS = 16
SLICE_BLOCKS = 32
SLICES = 256
PROBE = 32
DEPTHS = (0.03, 0.125, 0.4)
WORTH = 0.05
FEW = 48


def quantise(vector: Column, scale: int = 256) -> Column:
    """Whole numbers floor(scale * x), or null if the vector takes no part."""
    values = F.transform(vector, lambda x: x.cast("double"))
    fine = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(fine, F.transform(values, lambda x: F.floor(scale * x)))


def read_block(
    queries: np.ndarray, query_ids: np.ndarray, vectors: np.ndarray, ids: np.ndarray, k: int, least: np.ndarray
) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each query, the scores and ids of the block that may be among the k best.

    ``least`` holds the k-th best scores known from other blocks.
    """
    rows, scores, names = _best(*_candidates(queries, query_ids, vectors, ids, k, least), k)
    ends = np.searchsorted(rows, np.arange(len(queries) + 1))
    return [(scores[i:j], names[i:j]) for i, j in zip(ends, ends[1:], strict=False)]


def _candidates(
    queries: np.ndarray, query_ids: np.ndarray, vectors: np.ndarray, ids: np.ndarray, k: int, least: np.ndarray,
    lists: np.ndarray | None = None,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of queries, scores and ids of the vectors that may be among the k best; ``lists`` are the sorted columns."""
    lists = np.sort(vectors, axis=0) if lists is None else lists
    left, found = np.arange(len(queries)), []
    # bounds that hardly close any query here won't pay: a few queries tell
    if len(left) <= PROBE or _closed(queries[:PROBE], query_ids[:PROBE], vectors, ids, k, least[:PROBE], lists, DEPTHS[0])[0].mean() >= WORTH:
        for depth in DEPTHS:
            done, reach = _closed(queries[left], query_ids[left], vectors, ids, k, least[left], lists, depth)
            row, at = np.nonzero(reach & done[:, None])
            row = left[row]
            found.append((row, at, np.einsum("ij,ij->i", queries[row], vectors[at])))
            left = left[~done]
            if not len(left) or done.mean() < WORTH:
                break
    if len(left):
        found.append(_resolved(queries, query_ids, vectors, ids, k, least, left))
    row, at, scores = (np.concatenate(x) for x in zip(*found, strict=True))
    other = ids[at] != query_ids[row]
    return row[other], scores[other], ids[at[other]]


def _closed(queries, query_ids, vectors, ids, k, least, lists, depth) -> tuple[np.ndarray, np.ndarray]:
    """Which queries have few vectors left that can be among the best, after a part of each list, and which vectors those are."""
    n = len(vectors)
    entries = max(min(n, k + 1), int(depth * n))
    bottom, top, low, high = lists[0], lists[-1], lists[entries - 1], lists[n - entries]
    p, m = np.maximum(queries, 0), np.minimum(queries, 0)
    upper = p @ np.maximum(vectors, high).T + m @ np.minimum(vectors, low).T
    lower = p @ np.where(vectors >= high, vectors, bottom).T + m @ np.where(vectors <= low, vectors, top).T
    own = query_ids[:, None] == ids[None, :]
    upper[own] = lower[own] = -np.inf
    known = np.partition(lower, n - k, axis=1)[:, n - k] if n > k else np.full(len(queries), -np.inf)
    reach = (upper >= np.maximum(known, least)[:, None]) & ~own
    return reach.sum(axis=1) <= FEW, reach


def _resolved(queries, query_ids, vectors, ids, k, least, left) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Scores of whole lists that reach the k-th best, of this block where no other block has told one yet."""
    n = len(vectors)
    scores, least = queries[left] @ vectors.T, least[left].copy()
    new = np.flatnonzero(np.isinf(least))
    if len(new) and n > k:
        others = np.where(query_ids[left[new]][:, None] == ids[None, :], -np.inf, scores[new])
        least[new] = np.partition(others, n - k, axis=1)[:, n - k]
    row, at = np.nonzero(scores >= least.astype(scores.dtype)[:, None])
    return left[row], at, scores[row, at]


def _best(rows: np.ndarray, scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best of each row, in order; equal scores go to the smaller id."""
    order = np.lexsort((ids, -scores, rows))
    rows = rows[order]
    kept = np.arange(len(rows)) - np.searchsorted(rows, rows) < k
    return rows[kept], scores[order[kept]], ids[order[kept]]


def _matrix(values: pa.ListArray) -> np.ndarray:
    flat = values.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(values), -1)


def _most(values: np.ndarray) -> float:
    return max(float(values.max(initial=0)), -float(values.min(initial=0)))


def _exact(query: float, vector: float, dim: int) -> type:
    """Floats or doubles hold the products of components up to these exactly unless they are huge."""
    bound = query * vector * dim
    return np.float32 if bound < 2.0**24 else np.float64 if bound < 2.0**53 else object


_BLOCK = pa.schema([("ids", pa.binary()), ("tags", pa.binary()), ("values", pa.binary()), ("kind", pa.string())])


def _write_blocks(blocks: DataFrame, label: str) -> DataFrame:
    """``dim, block, uri, place``: where each block of ``rows`` stands, one file per task."""
    folder = shared_uri(blocks.sparkSession, label)

    def write(batches):
        out, told = None, []
        for batch in batches:
            for i in range(batch.num_rows):
                if out is None:
                    sink, uri = write_once(folder, "blocks")
                    out = pa.ipc.new_file(sink, _BLOCK)
                rows = batch.column("rows")[i].values
                ids, tags = (rows.field(c).to_numpy(zero_copy_only=False) for c in ("id", "tag"))
                order = np.lexsort((tags, ids))
                values = _matrix(rows.field("v"))[order]
                most = max(int(values.max()), -1 - int(values.min()))
                values = values.astype(np.int16 if most < 1 << 15 else np.int32 if most < 1 << 31 else np.int64)
                out.write_batch(pa.RecordBatch.from_pylist([{
                    "ids": ids[order].astype(np.int64).tobytes(), "tags": tags[order].astype(np.int64).tobytes(),
                    "values": values.tobytes(), "kind": values.dtype.str,
                }], schema=_BLOCK))
                told.append({"dim": batch.column("dim")[i].as_py(), "block": batch.column("block")[i].as_py(), "uri": uri, "place": len(told)})
        if told:
            out.close()
            sink.close()
            yield pa.RecordBatch.from_pylist(told, schema=pa.schema([("dim", pa.int32()), ("block", pa.int64()), ("uri", pa.string()), ("place", pa.int32())]))

    return stage(blocks.mapInArrow(write, "dim int, block long, uri string, place int"), label)


def _read_blocks(blocks: list[dict], dim: int):
    """``ids, tags, vectors`` of each block, one at a time."""
    for block in blocks:
        store, path = open_store(block["uri"])
        with store.open_input_file(path) as source:
            held = pa.ipc.open_file(source).get_batch(block["place"]).to_pylist()[0]
        ids, tags = (np.frombuffer(held[c], np.int64) for c in ("ids", "tags"))
        yield ids, tags, np.frombuffer(held["values"], held["kind"]).reshape(-1, dim)


class _Held:
    """A block of vectors, and its sorted columns, in the kinds of numbers that were asked for."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors, self.most, self.kinds = ids, vectors, _most(vectors), {}
        self.lists = np.sort(vectors, axis=0)

    def of(self, kind: type) -> tuple[np.ndarray, np.ndarray]:
        if kind not in self.kinds:
            self.kinds[kind] = self.vectors.astype(kind), self.lists.astype(kind)
        return self.kinds[kind]


class _Asked:
    """A block of queries and the k best found for each so far."""

    def __init__(self, ids: np.ndarray, tags: np.ndarray, queries: np.ndarray, k: int):
        self.ids, self.tags, self.queries, self.k, self.most = ids, tags, queries, k, _most(queries)
        self.rows, self.scores, self.names = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
        self.least = np.full(len(ids), -np.inf)

    def add(self, held: _Held) -> None:
        kind = _exact(self.most, held.most, self.queries.shape[1])
        if kind is object:
            found = [_plain(q, name, held.vectors, held.ids, self.k) for q, name in zip(self.queries, self.ids, strict=True)]
            rows = np.repeat(np.arange(len(found)), [len(s) for s, _ in found])
            scores, names = np.concatenate([s for s, _ in found]).astype(np.int64), np.concatenate([x for _, x in found])
        else:
            vectors, lists = held.of(kind)
            rows, scores, names = _candidates(self.queries.astype(kind), self.ids, vectors, held.ids, self.k, self.least, lists)
            scores = scores.astype(np.int64)
        joined = [np.concatenate(x) for x in ((self.rows, rows), (self.scores, scores), (self.names, names))]
        self.rows, self.scores, self.names = _best(*joined, self.k)
        first, last = (np.searchsorted(self.rows, np.arange(len(self.ids)), side) for side in ("left", "right"))
        full = last - first == self.k
        # as a double, a huge score may be too high by rounding
        self.least[full] = np.nextafter(self.scores[last[full] - 1].astype(np.float64), -np.inf)

    def told(self) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({
            "query_id": pa.array(self.ids[self.rows]), "query_tag": pa.array(self.tags[self.rows]),
            "vec_id": pa.array(self.names), "score": pa.array(self.scores),
        })


def top_k(
    vectors: DataFrame, is_query: Column, k: int = 5, key: str = "vec_id", vector: str = "embedding",
    query_block: int = QUERY_BLOCK, vector_block: int = VECTOR_BLOCK,
) -> DataFrame:
    """(query_id, rank, vec_id, score) of the rows for which ``is_query`` holds."""
    rows = vectors.select(
        F.col(key).cast("long").alias("id"), quantise(F.col(vector)).alias("v"), F.coalesce(is_query, F.lit(False)).alias("q")
    ).where("id is not null and v is not null").withColumns({"dim": F.size("v"), "tag": F.xxhash64("v")}).where("dim > 0")
    sizes = rows.agg(F.count("*").alias("n"), F.count(F.when(F.col("q"), 1)).alias("q")).first()
    n_blocks, q_blocks = math.ceil(sizes["n"] / vector_block) or 1, math.ceil(sizes["q"] / query_block) or 1
    cores = vectors.sparkSession.sparkContext.defaultParallelism
    n_slices = min(max(math.ceil(n_blocks / SLICE_BLOCKS), min(cores, n_blocks)), SLICES)
    n_groups = math.ceil(q_blocks / GROUP_BLOCKS)

    def blocked(part: DataFrame, count: int, label: str) -> DataFrame:
        # a set, built in the tasks that read the rows: repeated rows travel once
        return _write_blocks(part.groupBy("dim", F.pmod(F.xxhash64("id", "tag"), F.lit(count)).alias("block")).agg(
            F.collect_set(F.struct("id", "tag", "v")).alias("rows")
        ), label)

    def grouped(blocks: DataFrame, count: int, name: str) -> DataFrame:
        return blocks.groupBy("dim", F.pmod("block", F.lit(count)).alias(name)).agg(
            F.sort_array(F.collect_list(F.struct("block", "uri", "place"))).alias(f"{name}_blocks")
        )

    held = grouped(blocked(rows, n_blocks, "vector-blocks"), n_slices, "slice")
    asked = grouped(blocked(rows.where("q"), q_blocks, "query-blocks"), n_groups, "part")
    grid = held.join(asked, "dim").repartitionByRange(min(n_slices * n_groups, MAX_PARTITIONS), "dim", "slice", "part")

    def run(batches):
        for batch in batches:
            for cell in batch.select(["dim", "slice_blocks", "part_blocks"]).to_pylist():
                asked = [_Asked(*block, k) for block in _read_blocks(cell["part_blocks"], cell["dim"])]
                for ids, _, vectors in _read_blocks(cell["slice_blocks"], cell["dim"]):
                    held = _Held(ids, vectors)
                    for block in asked:
                        block.add(held)
                yield from (block.told() for block in asked)

    found = grid.mapInArrow(run, "query_id long, query_tag long, vec_id long, score long")
    place = "cast(row_number() over (partition by query_id, query_tag order by score desc, vec_id) as int) as rank"
    return found.selectExpr("*", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _plain(query: np.ndarray, name: int, held: np.ndarray, ids: np.ndarray, k: int):
    """Scores in whole numbers of any size, for components too large for doubles."""
    scores = [sum(int(a) * int(b) for a, b in zip(query, row, strict=True)) for row in held]
    best = sorted((-s, int(i)) for s, i in zip(scores, ids, strict=True) if i != name)[:k]
    return np.array([-s for s, _ in best], dtype=object), np.array([i for _, i in best], dtype=np.int64)
