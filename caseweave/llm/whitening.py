"""Whitening of integer vectors by the leading principal components of their covariance.

The covariance is never formed: its products with a block of vectors are sums over all rows, taken by the tasks
that hold the rows. The driver keeps blocks of at most as many vectors as the search space has.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .batches import carried_fields
from .jacobi_davidson import EPS, leading_pairs
from .vectors import commonest_length, matrix, whole

COMPONENTS = 8
CHUNK = 4096  # rows that are multiplied at once


@dataclass
class Whitening:
    """What all rows share: their number, the sums of each dimension, and the components as columns.

    products: passes over the rows that the eigenvectors took.
    """

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    products: int = 0

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - sums / n, with one rounding: the whole part is taken off as integers."""
        return _centred(x, self.n, self.sums)


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    parts = [divmod(s, n) for s in sums]
    return (x - np.array([q for q, _ in parts], np.int64)) - np.array([r / n for _, r in parts])


def in_chunks(rows: DataFrame) -> DataFrame:
    """The vectors of `rows` (one column of arrays of one length) as a table of chunks: d and their bytes.

    Every product reads all vectors again. A chunk is one value for Spark, so that costs little more than the bytes.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, CHUNK):
                x = matrix(batch.column(0).slice(at, CHUNK)).astype("<i8")
                yield pa.RecordBatch.from_arrays([pa.array([x.shape[1]], pa.int64()), pa.array([x.tobytes()])], names=["d", "chunk"])

    return cut_lineage(rows.mapInArrow(run, "d bigint, chunk binary"))


def _summed(chunks: DataFrame, add: Callable[[np.ndarray], np.ndarray], size: int, kind: str) -> list:
    """Sum of add(chunk) over all chunks: an array of `size` numbers.

    Each task sends its own sums, which are added by position, so what is shuffled is `size` rows a task, and the
    driver gets `size` rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for d, chunk in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                part = add(np.frombuffer(chunk.as_buffer(), "<i8").reshape(-1, d))
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(size)), pa.array(total)], names=["i", "v"])

    found = chunks.mapInArrow(run, f"i bigint, v {kind}").groupBy("i").agg(F.sum("v").alias("v")).collect()
    out = [0] * size
    for r in found:
        out[r["i"]] = r["v"]
    return out


def fit(chunks: DataFrame, k: int = COMPONENTS) -> Whitening:
    """The k leading components of the covariance of integer vectors (divisor n), to double precision.

    chunks: the vectors, from in_chunks. Components without variance (eigenvalue at most d * EPS of the largest) are left out: there are fewer
    than k of them for vectors of fewer dimensions or rank, and none for a single row or equal rows.
    """
    found = chunks.select("d").first()
    if not found:
        return Whitening(0, [], np.empty(0), np.empty((0, 0)), 0.0)
    d = found["d"]
    n, *sums = (int(s) for s in _summed(chunks, lambda x: np.r_[len(x), x.sum(axis=0)], d + 1, "bigint"))
    trace = float(_summed(chunks, lambda x: np.array([np.sum(_centred(x, n, sums) ** 2)]), 1, "double")[0]) / n

    def product(block: np.ndarray) -> np.ndarray:
        def add(x: np.ndarray) -> np.ndarray:
            c = _centred(x, n, sums)
            return (c.T @ (c @ block)).ravel()

        return np.array(_summed(chunks, add, block.size, "double"), np.float64).reshape(block.shape) / n

    values, vectors, products = leading_pairs(product, d, k)
    good = values > d * EPS * max(values[0], 0.0)
    return Whitening(n, sums, values[good], vectors[:, good], trace, products)


def whiten(rows: DataFrame, model: Whitening, carry: tuple[str, ...] = (), name: str = "x") -> DataFrame:
    """The columns to carry, deviation and whitened (one double for each component) of each row.

    deviation is the exact sum over dimensions of (n * x - sum) ** 2, null where that does not fit a long.
    """
    if clash := {"deviation", "whitened"} & set(carry):
        raise ValueError(f"columns {sorted(clash)} have names of results")
    scales = np.sqrt(model.values)

    def deviations(x: np.ndarray) -> pa.Array:
        parts = [divmod(s, model.n) for s in model.sums]
        off = x - np.array([q for q, _ in parts], np.int64)
        rest = [r for _, r in parts]
        about = np.sum((off * float(model.n) - np.array(rest, np.float64)) ** 2, axis=1)
        exact = [None] * len(x)
        small = about < 2.0**61
        t = off[small] * np.int64(model.n) - np.array(rest, np.int64)
        for at, value in zip(np.flatnonzero(small), np.sum(t * t, axis=1).tolist(), strict=True):
            exact[at] = value
        for at in np.flatnonzero(~small):
            value = sum((int(o) * model.n - r) ** 2 for o, r in zip(off[at], rest, strict=True))
            exact[at] = value if value < 2**63 else None
        return pa.array(exact, pa.int64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, CHUNK):
                part = batch.slice(at, CHUNK)
                x = matrix(part.column(len(carry)))
                scores = model.centred(x) @ model.vectors / scales
                ends = pa.array(np.arange(len(x) + 1, dtype=np.int32) * len(scales), pa.int32())
                found = pa.ListArray.from_arrays(ends, pa.array(scores.ravel()))
                old = [part.column(c) for c in range(len(carry))]
                yield pa.RecordBatch.from_arrays([*old, deviations(x), found], names=[*carry, "deviation", "whitened"])

    fields = carried_fields(rows, carry, {"deviation": "bigint", "whitened": "array<double>"})
    return rows.select(*(F.col(f"`{c}`") for c in carry), name).mapInArrow(run, fields)


def identity_error(chunks: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the covariance of all whitened rows minus the identity; 0 without components."""
    k, scales = len(model.values), np.sqrt(model.values)
    if not k:
        return 0.0

    def add(x: np.ndarray) -> np.ndarray:
        w = model.centred(x) @ model.vectors / scales
        return np.concatenate([w.sum(axis=0), (w.T @ w).ravel()])

    both = np.array(_summed(chunks, add, k + k * k, "double"), np.float64) / model.n
    mean, second = both[:k], both[k:].reshape(k, k)
    return float(np.abs(second - np.outer(mean, mean) - np.eye(k)).max())


def whitened_rows(
    df: DataFrame, id_col: str, vector_col: str, scale: int, offset: int, k: int = COMPONENTS
) -> tuple[DataFrame, Whitening, float]:
    """id_col, deviation and whitened of each row of df that has a whole vector, the model and its identity error.

    Vectors that are null, empty, not finite or not of the commonest length (the greater of equals) take no part,
    neither in the fit. Every row counts, also those that share an id, repeat another or have a null id. Without
    rows that take part the result is empty. Other columns are not read.
    """
    rows = whole(df.select(F.col(f"`{id_col}`"), F.col(f"`{vector_col}`").alias("__v")), "__v", scale, offset, "__x")
    rows = rows.select(F.col(f"`{id_col}`"), "__x")
    d, _ = commonest_length(rows, "__x")
    rows = cut_lineage(rows.filter(F.size("__x") == d))
    chunks = in_chunks(rows.select("__x"))
    model = fit(chunks, k)
    return whiten(rows, model, (id_col,), "__x"), model, identity_error(chunks, model)
