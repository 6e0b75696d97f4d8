"""Exact top-k search by inner product with multi-resolution segment statistics.

For a segment of length n with means m, M and deviations s, S of query and vector, the squared distance is at
least n * ((m - M) ** 2 + (s - S) ** 2), so the inner product is at most n * (m * M + s * S). Bounds of few
long segments discard most vectors; what is left meets more and shorter segments, and only survivors are
multiplied out.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LEVELS = (4, 16, 32)  # segments of each resolution
BLOCK = 8192


def _statistics(vectors: np.ndarray, segments: int) -> np.ndarray:
    """sqrt(n) * mean and sqrt(n) * deviation of each segment: their products add up to the bound."""
    edges = np.linspace(0, vectors.shape[1], segments + 1).astype(int)
    edges = np.unique(edges)
    sizes = np.diff(edges)
    means = np.add.reduceat(vectors, edges[:-1], axis=1) / sizes
    squares = np.add.reduceat((vectors - np.repeat(means, sizes, axis=1)) ** 2, edges[:-1], axis=1)
    return np.hstack([means * np.sqrt(sizes), np.sqrt(squares)])


def search_block(
    ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query id, id, score) of the k best vectors of this block for each query, ties to smaller ids."""
    order = np.argsort(ids, kind="stable")
    ids, vectors = ids[order], vectors[order]
    levels = [s for s in LEVELS if s < vectors.shape[1]] or [1]
    x, q = vectors.astype(np.float64), queries.astype(np.float64)
    own = [_statistics(x, s) for s in levels]
    asked = [_statistics(q, s) for s in levels]
    slack = 1e-9 * np.linalg.norm(x, axis=1).max(initial=0.0)
    out = []
    for start in range(0, len(queries), 256):
        bounds = asked[0][start : start + 256] @ own[0].T
        for row, bound in enumerate(bounds, start):
            near = 1e-6 + slack * np.linalg.norm(q[row])
            other = ids != query_ids[row]
            bound[~other] = -np.inf
            take = min(k, int(other.sum()))
            if not take:
                continue
            # the exact scores of the most promising give the score to beat
            first = np.argpartition(-bound, take - 1)[:take]
            least = float((vectors[first] @ queries[row]).min())
            left = np.flatnonzero(bound >= least - near)
            for level in range(1, len(levels)):
                bound = own[level][left] @ asked[level][row]
                best = left[np.argpartition(-bound, take - 1)[:take]]
                least = max(least, float((vectors[best] @ queries[row]).min()))
                left = left[bound >= least - near]
            scores = vectors[left] @ queries[row]
            best = np.lexsort((ids[left], -scores))[:take]
            out.append((np.full(take, query_ids[row]), ids[left][best], scores[best]))
    if not out:
        return (np.empty(0, np.int64),) * 3
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def whole_vectors(df: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """id and floor(scale * x) of each vector that is not null and has only finite components.

    Rows with a null id take no part. Of rows that share an id the smallest vector counts, once.
    """
    x = F.transform(vector_col, lambda c: c.cast("double"))
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    kept = df.filter(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & F.coalesce(finite, F.lit(False)))
    return kept.select(
        F.col(id_col).cast("long").alias("id"), F.transform(x, lambda c: F.floor(c * scale)).alias("v")
    ).groupBy("id").agg(F.min("v").alias("v"))


def top_k(vectors: DataFrame, queries: Column, k: int = 20, block: int = BLOCK) -> DataFrame:
    """query_id, rank, vec_id and score of the k best vectors for each query.

    vectors: id and v (array of long); queries: which ids are asked for. All queries meet all vectors of their
    own length but themselves, block by block: a task holds one block of either. Scores are 64-bit integers.
    An empty table gives an empty one.
    """
    sized = vectors.withColumn("d", F.size("v"))
    n, asked = sized.agg(F.count(F.lit(1)), F.sum(queries.cast("long"))).first()
    across, down = max(1, math.ceil(n / block)), max(1, math.ceil((asked or 0) / block))
    every = lambda parts: F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    own = lambda parts, seed: F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(parts)).cast("int")
    right = sized.select("d", "id", "v", own(across, 1).alias("c"), every(down).alias("r"))
    left = sized.filter(queries).select("d", "id", "v", own(down, 2).alias("r"), every(across).alias("c"))

    def matrix(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        ids = table.column("id").to_numpy()
        values = table.column("v").combine_chunks()
        flat = values.flatten().to_numpy(zero_copy_only=False)
        return ids, flat.reshape(len(ids), -1) if len(flat) else np.zeros((len(ids), 1), np.int64)

    def run(asked: pa.Table, held: pa.Table) -> pa.Table:
        names = ["query_id", "vec_id", "score"]
        if not asked.num_rows or not held.num_rows:
            return pa.table({x: pa.array([], pa.int64()) for x in names})
        query_ids, q = matrix(asked)
        ids, x = matrix(held)
        return pa.table(dict(zip(names, map(pa.array, search_block(ids, x, query_ids, q, k)), strict=True)))

    pairs = left.groupBy("d", "r", "c").cogroup(right.groupBy("d", "r", "c"))
    found = pairs.applyInArrow(run, "query_id bigint, vec_id bigint, score bigint")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
