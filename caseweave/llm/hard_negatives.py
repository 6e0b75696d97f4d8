"""Hard negatives of anchors by inner product, with bounds along a spanning tree of the anchors.

For an anchor a, its parent p in the tree and a candidate c, <a, c> lies within |a - p| * |c| of <p, c>. So a score, or
a range of scores, known at the parent gives a range for the child, and only candidates whose range meets one of the
child's windows are multiplied out. Lists that are full narrow the windows as the candidates go by.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .vectors import matrix

TREE = 1024  # most anchors of a tree
BLOCK_BYTES = 16 << 20  # most bytes of anchors that are broadcast at once
CHUNK = 2048  # candidates that meet a tree at once
DENSE = 0.1  # share of candidates from which a level is multiplied out as one matrix product
EXACT = 2.0**53
LEAST, MOST = -(2**63) + 1, 2**63 - 1
_BUFFER = 1 << 18


def spanning_tree(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of the rows, and for each place in it the place of its parent and the length of its edge.

    A minimum spanning tree by Prim's method from the row nearest to the mean. Parents come before their
    children; the root is its own parent.
    """
    x = x.astype(np.float64)
    n = len(x)
    squares = np.einsum("ij,ij->i", x, x)
    mean = x.mean(axis=0)
    at = int(np.argmin(squares - 2 * (x @ mean)))
    order, parent, edge = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n)
    order[0] = at
    near, best = np.zeros(n, np.int64), np.full(n, np.inf)
    out = np.zeros(n, bool)
    out[at] = True
    for k in range(1, n):
        away = squares + squares[at] - 2 * (x @ x[at])
        closer = away < best
        best[closer], near[closer] = away[closer], k - 1
        at = int(np.argmin(np.where(out, np.inf, best)))
        order[k], parent[k], out[at] = at, near[at], True
        edge[k] = np.linalg.norm(x[at] - x[order[near[at]]])
    return order, parent, edge


@dataclass
class Tree:
    """Anchors in the order of their tree, with what they look for.

    low, high (anchors x windows, long): a candidate is wanted if its score lies in a window and its label is the
    anchor's (same) or is not. Each window keeps its `most` best candidates.
    """

    keys: np.ndarray
    ids: np.ndarray
    labels: np.ndarray
    x: np.ndarray
    parent: np.ndarray
    edge: np.ndarray
    low: np.ndarray
    high: np.ndarray
    same: bool
    most: int

    def levels(self) -> list[np.ndarray]:
        depth = np.zeros(len(self.keys), np.int64)
        for k in range(1, len(depth)):
            depth[k] = depth[self.parent[k]] + 1
        order = np.argsort(depth, kind="stable")
        return np.split(order, np.flatnonzero(np.diff(depth[order])) + 1)


class Search:
    """The best candidates so far of all windows of one tree."""

    def __init__(self, tree: Tree):
        self.tree, self.low, self.levels = tree, tree.low.copy(), tree.levels()
        self.x = tree.x.astype(np.float64)
        self.norms = np.linalg.norm(self.x, axis=1)
        self.pending: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.waiting = 0
        none = np.empty(0, np.int64)
        self.held = (none, none, none)
        self.met = self.rescored = 0  # pairs of an anchor and a candidate of the wanted label

    def add(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray) -> None:
        """Meet a chunk of candidates."""
        tree, largest = self.tree, float(np.abs(x).max(initial=0)) * float(np.abs(self.tree.x).max(initial=0)) * x.shape[1]
        if largest >= 2.0**63:
            raise OverflowError("inner products do not fit a long")
        exact = largest < EXACT
        own, anchors = (x.astype(np.float64), self.x) if exact else (x, tree.x)
        norms = np.linalg.norm(x.astype(np.float64), axis=1)
        slack = 1 + 1e-9 * float((norms.max(initial=0) + 1) * (self.norms.max(initial=0) + 1))
        low, high = np.empty((len(self.norms), len(ids))), np.empty((len(self.norms), len(ids)))
        for level, at in enumerate(self.levels):
            least, most = self.low[at].min(axis=1, initial=MOST), tree.high[at].max(axis=1, initial=LEAST)
            wanted = (tree.labels[at][:, None] == labels) == tree.same
            if tree.same:
                wanted &= tree.ids[at][:, None] != ids
            reach = self.norms[at][:, None] * norms
            if level:
                up = tree.parent[at]
                span = tree.edge[at][:, None] * norms + slack
                bottom, top = np.maximum(low[up] - span, -reach - slack), np.minimum(high[up] + span, reach + slack)
            else:
                bottom, top = -reach - slack, reach + slack
            low[at], high[at] = bottom, top
            near = wanted & (top >= least[:, None]) & (bottom <= most[:, None])
            many = int(near.sum())
            self.met += int(wanted.sum())
            self.rescored += many
            if not many and level:
                continue
            if not level or many > DENSE * near.size:
                scores = anchors[at] @ own.T
                low[at] = high[at] = scores
                near &= (scores >= least[:, None]) & (scores <= most[:, None])
                rows, columns = np.nonzero(near)
                found = scores[rows, columns]
            else:
                rows, columns = np.nonzero(near)
                found = np.concatenate(
                    [np.einsum("ij,ij->i", anchors[at[rows[k : k + 65536]]], own[columns[k : k + 65536]]) for k in range(0, many, 65536)]
                )
                low[at[rows], columns] = high[at[rows], columns] = found
                good = (found >= least[rows]) & (found <= most[rows])
                rows, columns, found = rows[good], columns[good], found[good]
            self.pending.append((at[rows], found.astype(np.int64), ids[columns]))
            self.waiting += len(rows)
        if self.waiting > _BUFFER or not len(self.held[0]):
            self.settle()

    def windows(self) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """(window, anchors, scores, ids) of the best of each window, best first."""
        every = [self.held, *self.pending]
        anchor, score, ids = (np.concatenate([e[k] for e in every]) for k in range(3))
        order = np.lexsort((ids, -score, anchor))
        anchor, score, ids = anchor[order], score[order], ids[order]
        once = np.ones(len(ids), bool)  # rows of one id and one score count once
        once[1:] = (anchor[1:] != anchor[:-1]) | (score[1:] != score[:-1]) | (ids[1:] != ids[:-1])
        anchor, score, ids = anchor[once], score[once], ids[once]
        for w in range(self.low.shape[1]):
            fits = np.flatnonzero((score >= self.low[anchor, w]) & (score <= self.tree.high[anchor, w]))
            own = anchor[fits]
            heads = np.flatnonzero(np.r_[True, own[1:] != own[:-1]]) if len(own) else np.empty(0, np.int64)
            place = np.arange(len(own)) - np.repeat(heads, np.diff(np.r_[heads, len(own)]))
            kept = fits[place < self.tree.most]
            yield w, anchor[kept], score[kept], ids[kept]

    def settle(self) -> None:
        """Drop what no window keeps, and raise the lower ends of full windows to their last score."""
        parts = []
        for w, anchor, score, ids in list(self.windows()):
            parts.append((anchor, score, ids))
            counts = np.bincount(anchor, minlength=len(self.low))
            full = np.flatnonzero(counts >= self.tree.most)
            last = np.cumsum(counts)[full] - 1
            self.low[full, w] = np.maximum(self.low[full, w], score[last])
        if parts:
            every = np.unique(np.stack([np.concatenate([p[k] for p in parts]) for k in range(3)]), axis=1)
            self.held = (every[0], every[1], every[2])
        self.pending, self.waiting = [], 0


def _scan(rows: DataFrame, trees: list[Tree]) -> DataFrame:
    """key, window, id and score of the best candidates that each task found for each window.

    rows: id, label, x. The trees are broadcast; they are at most BLOCK_BYTES of anchors and their windows.
    """
    shared = rows.sparkSession.sparkContext.broadcast(trees)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searches = [Search(t) for t in shared.value]
        chunk = CHUNK // 8  # a first small one gives scores to beat
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                part = batch.slice(at, chunk)
                ids, labels, x = part.column(0).to_numpy(), part.column(1).to_numpy(), matrix(part.column(2))
                for s in searches:
                    s.add(ids, labels, x)
                at, chunk = at + chunk, CHUNK
        for s in searches:
            for w, anchor, score, ids in s.windows():
                yield pa.RecordBatch.from_arrays(
                    [pa.array(s.tree.keys[anchor]), pa.array(np.full(len(ids), w, np.int32)), pa.array(ids), pa.array(score)],
                    names=["key", "window", "id", "score"],
                )

    return rows.select("id", "label", "x").mapInArrow(run, "key bigint, window int, id bigint, score bigint")


def _best(found: DataFrame, most: int) -> DataFrame:
    """rank (from 1) of the `most` best of each window, equal rows once."""
    order = Window.partitionBy("key", "window").orderBy(F.desc("score"), "id")
    ranked = found.withColumn("rank", F.dense_rank().over(order)).filter(F.col("rank") <= most)
    return ranked.dropDuplicates(["key", "window", "rank"])


def _forest(rows: DataFrame, anchors: Column, d: int) -> tuple[DataFrame, int]:
    """Anchors of length d by tree and place in it, each tree made by one task, and the number of trees."""
    chosen = rows.filter(anchors & (F.size("x") == d)).select("id", "label", "x").distinct()
    parts = max(1, -(-2 * chosen.count() // TREE))  # hashing fills half of a tree on average, hardly ever a whole one
    dealt = chosen.withColumn("tree", F.pmod(F.xxhash64("id", "x"), F.lit(parts)))

    def run(table: pa.Table) -> pa.Table:
        x = matrix(table.column("x").combine_chunks())
        order, parent, edge = spanning_tree(x)
        table = table.take(pa.array(order))
        place = pa.array(np.arange(len(order)))
        return pa.table({
            "tree": table.column("tree"), "place": place, "parent": pa.array(parent), "edge": pa.array(edge),
            "id": table.column("id"), "label": table.column("label"), "x": table.column("x"),
        })

    fields = "tree bigint, place bigint, parent bigint, edge double, id bigint, label bigint, x array<bigint>"
    return cut_lineage(dealt.groupBy("tree").applyInArrow(run, fields)), parts


def mine(
    rows: DataFrame, anchors: Column, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score of the hard negatives.

    rows: id, label (long) and x (array of long), none null; anchors: which rows are anchors. The score of a row
    is its inner product with the anchor; higher scores come first, ties by smaller id. An anchor's positives are
    its first `positives` rows of the same label and another id. For each of them the first `negatives` rows of other labels
    with low * positive_score <= 100 * score <= high * positive_score are returned, all if fewer.

    Only rows of the anchor's length meet it. Rows of one id that score alike with an anchor count once for it, so
    repeated rows change nothing; different rows of one id are rows of their own, as anchors too. An anchor
    without a positive gives no row, nor does a positive without a negative. An empty table gives an empty one. Scores
    that do not fit a long are an error.

    Candidates are never shuffled: each task meets its own rows with one block of anchors at a time, and only the
    best of each task are ranked. There are as many passes over the rows as blocks of BLOCK_BYTES.
    """
    spark, rows = rows.sparkSession, cut_lineage(rows.select("id", F.col("label").cast("long").alias("label"), "x"))
    out = spark.createDataFrame(
        [], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    )
    lengths = [r["d"] for r in rows.filter(anchors).select(F.size("x").alias("d")).distinct().orderBy("d").collect() if r["d"] > 0]
    for d in lengths:
        forest, parts = _forest(rows, anchors, d)
        alike = rows.filter(F.size("x") == d)
        # a tree has TREE anchors at most, but for chance; a block is a run of trees
        block = max(1, BLOCK_BYTES // (TREE * 8 * d))
        for first in range(0, parts, block):
            own = forest.filter((F.col("tree") >= first) & (F.col("tree") < first + block))
            out = out.unionByName(_mine_block(alike, own, positives, negatives, low, high))
    return out


def _mine_block(rows: DataFrame, forest: DataFrame, positives: int, negatives: int, low: int, high: int) -> DataFrame:
    table = forest.orderBy("tree", "place").toArrow()
    x = matrix(table.column("x").combine_chunks())
    column = {c: table.column(c).to_numpy() for c in ("tree", "place", "parent", "edge", "id", "label")}
    keys = (column["tree"] << 20) + column["place"]
    edges = np.r_[np.flatnonzero(np.diff(column["tree"], prepend=-1)), len(keys)]

    def trees(least: np.ndarray, most: np.ndarray, same: bool, count: int) -> list[Tree]:
        return [
            Tree(keys[a:b], column["id"][a:b], column["label"][a:b], x[a:b], column["parent"][a:b], column["edge"][a:b],
                 least[a:b], most[a:b], same, count)
            for a, b in zip(edges[:-1], edges[1:], strict=True)
        ]

    ends = np.full((len(keys), 1), MOST)
    found = _best(_scan(rows, trees(-ends, ends, True, positives)), positives)
    best = cut_lineage(found.select("key", (F.col("rank") - 1).alias("window"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")))
    pairs = best.toArrow()  # a few rows for each anchor of the block
    least, most = np.full((len(keys), positives), MOST), np.full((len(keys), positives), LEAST)
    at = np.searchsorted(keys, pairs.column("key").to_numpy()), pairs.column("window").to_numpy()
    scores = pairs.column("positive_score").to_pylist()  # Python's integers do not overflow
    least[at] = [min(MOST, max(LEAST, -(-low * s // 100))) for s in scores]
    most[at] = [min(MOST, max(LEAST, high * s // 100)) for s in scores]
    found = _best(_scan(rows, trees(least, most, False, negatives)), negatives)
    named = forest.select(F.shiftleft("tree", 20) + F.col("place"), F.col("id")).toDF("key", "anchor_id")
    return cut_lineage(
        found.join(best, ["key", "window"]).join(named, "key").select(
            "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
        )
    )
