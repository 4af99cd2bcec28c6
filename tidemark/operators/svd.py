"""Leading singular directions of the TF-IDF matrix.

Block Krylov iteration: every pass reads the sparse rows once, multiplies them with a
small block of directions and sums the products per term. Only the block (terms x
directions) travels to the tasks and back, never a document. The driver keeps the
blocks of all passes with their products, as both give the best directions so far and
how far each is from a true one, without another pass. Passes end by those residuals;
beyond ``BASIS_CELLS`` numbers the blocks are folded into the best directions.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.text import word_tokens
from tidemark.session import stage
from tidemark.operators.tfidf import (
    SLICE, TermVectors, as_lists, count_terms, fit_vectors, in_slices, row_runs, row_sizes, scaled, unit_rows,
)


BASIS_CELLS = 1 << 24  # numbers the driver keeps of all blocks; their products are as many


@dataclass(frozen=True)
class SvdModel:
    """Fitted directions (terms x components), their singular values and how exact they are.

    ``residuals`` are the lengths of (A^T A) v - s^2 v, as shares of the largest s^2. Each s^2 is at most that far
    from an eigenvalue of A^T A; a direction is wrong by about its residual over the gap to the next s^2.
    """

    vectors: TermVectors
    directions: np.ndarray
    singular_values: np.ndarray
    residuals: np.ndarray
    passes: int
    converged: bool

    def report(self) -> DataFrame:
        """``component, singular_value, residual, passes, converged``: one row per component."""
        rows = [
            (j + 1, float(value), float(rest), self.passes, self.converged)
            for j, (value, rest) in enumerate(zip(self.singular_values, self.residuals))
        ]
        names = "component int, singular_value double, residual double, passes int, converged boolean"
        return self.vectors.rows.sparkSession.createDataFrame(rows, names)

    def products(self) -> DataFrame:
        """``i, j, dot`` for i <= j: sums of score i x score j over the documents; s^2 where i = j, else 0."""
        names = [f"svd_{j + 1}" for j in range(self.directions.shape[1])]
        pairs = [(i, j) for i in range(len(names)) for j in range(i, len(names))]
        cells = self.scores().agg(*[F.sum(F.col(names[i]) * F.col(names[j])).alias(f"{i}_{j}") for i, j in pairs])
        listed = [F.struct(F.lit(i + 1).alias("i"), F.lit(j + 1).alias("j"), F.col(f"{i}_{j}").alias("dot")) for i, j in pairs]
        return cells.select(F.inline(F.array(*listed)))

    def scores(self) -> DataFrame:
        """``keys, svd_1, svd_2, ...`` for every fitted document with a kept term."""
        return self._scored(self.vectors.rows.where(F.size("_ids") > 0), self.vectors.keys)

    def carried(self) -> DataFrame:
        """Scores beside the carried columns, for every document of a fit that carries some; 0 without a kept term."""
        return self._scored(self.vectors.rows, [c for c in self.vectors.rows.columns if c not in ("_ids", "_tf")])

    def _scored(self, rows: DataFrame, names: Sequence[str]) -> DataFrame:
        project = _project(self.vectors.idf, self.directions)
        scored = rows.select(*names, project(F.col("_ids"), F.col("_tf")).alias("_s"))
        return scored.select(*names, *_components(F.col("_s"), self.directions))

    def score_text(self, text: Column) -> Column:
        """First component of texts that were not part of the fit, row by row (also in streams)."""
        counts = count_terms(self.vectors.vocabulary)(word_tokens(text))
        project = _project(self.vectors.idf, self.directions[:, :1])
        return project(counts["ids"], counts["tf"])[0]


def _components(scores: Column, directions: np.ndarray) -> list[Column]:
    return [scores[j].alias(f"svd_{j + 1}") for j in range(directions.shape[1])]


def _project(idf: Sequence[float], directions: np.ndarray):
    @F.arrow_udf(T.ArrayType(T.DoubleType()))
    def project(ids: pa.Array, tf: pa.Array) -> pa.Array:
        width = directions.shape[1]

        def some(ids: pa.Array, tf: pa.Array) -> pa.Array:
            flat, weights, rows = unit_rows(ids, tf, idf)
            along = [
                np.bincount(rows, weights=weights * directions[flat, j], minlength=len(ids))
                for j in range(width)
            ]
            return as_lists(np.column_stack(along).ravel(), np.full(len(ids), width), pa.float64())

        return in_slices(some, ids, tf)

    return project


def _packing(terms: int):
    """Turns batches of ids and counts into rows of packed numbers, one for every ``SLICE`` documents or fewer long ones."""
    kind = np.uint16 if terms <= 1 << 16 else np.int32

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, count in row_runs(row_sizes(batch.column(0)), SLICE):
                part = batch.slice(start, count)
                sizes = row_sizes(part.column(0)).astype(np.int32)
                tf = part.column(1).flatten().to_numpy(zero_copy_only=False)
                small = np.uint8 if tf.max(initial=0) < 1 << 8 else np.int32
                ids = part.column(0).flatten().to_numpy(zero_copy_only=False)
                cells = (ids.astype(kind), tf.astype(small), sizes)
                yield pa.RecordBatch.from_arrays([pa.array([c.tobytes()], pa.binary()) for c in cells], names=["ids", "tf", "sizes"])

    return pack


def packed_rows(vectors: TermVectors) -> DataFrame:
    """``ids, tf, sizes``: the sparse rows, ``SLICE`` of them in one, each column their numbers as bytes.

    A pass over them unpacks no lists: Spark hands on a few long values, where it would copy every number of every row.
    """
    pack = _packing(len(vectors.vocabulary))
    return vectors.rows.select("_ids", "_tf").mapInArrow(pack, "ids binary, tf binary, sizes binary")


def gram_times(vectors: TermVectors, block: np.ndarray) -> np.ndarray:
    """(A^T A) x block: one pass over the rows, partial sums per task, added up by Spark."""
    idf = np.asarray(vectors.idf)
    terms, width = block.shape
    kind = np.uint16 if terms <= 1 << 16 else np.int32

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((terms, width))
        for batch in batches:
            for packed in zip(*[batch.column(name) for name in ("ids", "tf", "sizes")]):
                ids, tf, sizes = [value.as_buffer() for value in packed]
                flat, sizes = np.frombuffer(ids, kind).astype(np.int64), np.frombuffer(sizes, np.int32)
                tf = np.frombuffer(tf, np.uint8 if tf.size == len(flat) else np.int32)
                rows = np.repeat(np.arange(len(sizes)), sizes)
                weights = scaled(tf * idf[flat], rows, len(sizes))
                for j in range(width):
                    along = np.bincount(rows, weights=weights * block[flat, j], minlength=len(sizes))
                    total[:, j] += np.bincount(flat, weights=weights * along[rows], minlength=terms)
        cells = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(cells, pa.int64()), pa.array(total.ravel()[cells])], names=["cell", "x"]
        )

    rows = packed_rows(vectors) if vectors.packed is None else vectors.packed
    sums = (
        rows.mapInArrow(partial, "cell bigint, x double")
        .groupBy("cell").agg(F.sum("x").alias("x"))
        .toArrow()
    )
    product = np.zeros(terms * width)
    product[sums.column("cell").to_numpy()] = sums.column("x").to_numpy()
    return product.reshape(terms, width)


def _start_block(terms: int, width: int) -> np.ndarray:
    block = np.random.default_rng(42).standard_normal((terms, width))
    block[:, 0] = 1.0  # weights are never negative, so the first direction is near this one
    return np.linalg.qr(block)[0]


def _new_directions(block: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """Orthonormal directions of what ``block`` adds to ``basis``; fewer columns, or none, where it adds less."""
    scale = np.linalg.norm(block, axis=0).max(initial=0.0)
    for _ in range(2):  # a second time for what rounding left
        block = block - basis @ (basis.T @ block)
    left, lengths, _ = np.linalg.svd(block, full_matrices=False)
    added = left[:, lengths > 1e-13 * scale]
    return np.linalg.qr(added - basis @ (basis.T @ added))[0]


def _krylov(vectors: TermVectors, components: int, oversample: int, passes: int, tolerance: float):
    terms = len(vectors.vocabulary)
    width = min(components + oversample, terms)
    block = _start_block(terms, width)
    basis, products = np.zeros((terms, 0)), np.zeros((terms, 0))
    directions, values, residuals, used, converged = block[:, :0], np.zeros(0), np.zeros(0), 0, False
    while used < passes and not converged:
        product = gram_times(vectors, block)
        used += 1
        basis, products = np.hstack([basis, block]), np.hstack([products, product])
        gram = basis.T @ products
        values, turn = np.linalg.eigh((gram + gram.T) / 2)
        best = np.argsort(values)[::-1][:width]
        values, turn = values[best], turn[:, best]
        directions, images = basis @ turn, products @ turn
        residuals = np.linalg.norm(images - directions * values, axis=0) / max(values[0], 1e-300)
        block = _new_directions(product, basis)
        converged = bool(np.all(residuals[:components] <= tolerance)) or block.shape[1] == 0
        if basis.size + block.size > max(BASIS_CELLS, 3 * terms * width):
            basis, products = directions, images
    return directions, values, residuals, used, converged


def _power(vectors: TermVectors, components: int, oversample: int, passes: int, tolerance: float):
    terms = len(vectors.vocabulary)
    block = _start_block(terms, min(components + oversample, terms))
    for _ in range(passes):
        product = gram_times(vectors, block)
        small, turn = np.linalg.eigh((block.T @ product + product.T @ block) / 2)
        best = np.argsort(small)[::-1]
        values, turn = small[best], turn[:, best]
        residuals = np.linalg.norm(product @ turn - block @ turn * values, axis=0) / max(values[0], 1e-300)
        block = np.linalg.qr(product @ turn)[0]
    return block, values, residuals, passes, bool(np.all(residuals[:components] <= tolerance))


def fit_directions(
    vectors: TermVectors,
    components: int = 1,
    oversample: int = 2,
    passes: int = 30,
    tolerance: float = 1e-9,
    method: str = "krylov",
) -> SvdModel:
    """Directions with their largest entry positive, best first.

    Passes end once all ``residuals`` of the kept components are at most ``tolerance``, or where the rows have no
    further direction. After ``passes`` the best so far is returned, with a warning and ``converged`` false.
    ``method="power"`` takes exactly ``passes`` steps of plain block iteration, which other tools can retrace; its residuals
    are those before the last step.
    """
    ways = {"krylov": _krylov, "power": _power}
    if method not in ways:
        raise ValueError(f"method is one of {sorted(ways)}, not {method!r}")
    if passes < 1 or components < 1:
        raise ValueError("at least one pass and one component")
    if not len(vectors.vocabulary):
        return SvdModel(vectors, np.zeros((0, components)), np.zeros(components), np.zeros(components), 0, True)
    packed = replace(vectors, packed=stage(packed_rows(vectors), "term-blocks"))
    found = ways[method](packed, components, oversample, passes, tolerance)
    directions, values, residuals = found[0][:, :components], found[1][:components], found[2][:components]
    if method == "krylov" and not found[4]:
        warnings.warn(f"SVD: residual {residuals.max():.1e} after {found[3]} passes, {tolerance:.1e} wanted")
    largest = directions[np.argmax(np.abs(directions), axis=0), np.arange(directions.shape[1])]
    directions = directions * np.where(largest < 0, -1.0, 1.0)
    return SvdModel(vectors, directions, np.sqrt(np.maximum(values, 0)), residuals, *found[3:])


def fit_svd(
    df: DataFrame,
    keys: Sequence[str],
    text: str,
    components: int = 1,
    max_features: int = 5000,
    carry: Sequence[str] = (),
    **options,
) -> SvdModel:
    """TF-IDF and its leading directions."""
    return fit_directions(fit_vectors(df, keys, text, max_features, carry), components, **options)


def with_svd(df: DataFrame, model: SvdModel) -> DataFrame:
    """Add ``svd_1, ...``; rows without a kept term score 0."""
    names = [f"svd_{j + 1}" for j in range(model.directions.shape[1])]
    joined = df.join(model.scores(), list(model.vectors.keys), "left")
    return joined.withColumns({name: F.coalesce(name, F.lit(0.0)) for name in names})
