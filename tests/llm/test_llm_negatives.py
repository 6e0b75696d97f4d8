"""Hard negatives against all inner products."""

import math
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from caseweave.llm import hard_negatives, queries, vectors


def brute(rows, is_anchor, positives=5, negatives=10, low=30, high=90):
    """rows: (id, label, x) without nulls."""
    out = []
    for a, la, xa in sorted({r for r in rows if is_anchor(r[0])}):
        scored = {(sum(p * q for p, q in zip(xa, x, strict=True)), i, lab == la) for i, lab, x in rows
                  if len(x) == len(xa) and (i != a or lab != la)}
        first = lambda same: sorted(((s, i) for s, i, own in scored if own == same), key=lambda r: (-r[0], r[1]))
        others = first(False)
        for score, p in [r for r in first(True) if r[1] != a][:positives]:
            fits = [(s, i) for s, i in others if low * score <= 100 * s <= high * score][:negatives]
            out += [(a, p, k + 1, i, score, s) for k, (s, i) in enumerate(fits)]
    return sorted(out)


def found(df):
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r[c] for c in names) for r in df.collect())


def test_query_against_plain_python(spark, sf):
    rows = []
    for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect():
        label = (r["label"] + 1) % 10 if r["vec_id"] % 7 == 0 else r["label"]
        rows.append((r["vec_id"], label, tuple(math.floor(256 * float(c)) for c in r["embedding"])))
    want = brute(rows, lambda i: i % 100 == 0)
    assert want and found(queries.op13_hard_negatives(spark, sf)) == want


@pytest.mark.parametrize("small", [False, True])
def test_ties_repeats_and_lengths(spark, monkeypatch, small):
    """Few distinct small vectors, other lengths, repeated rows and ids, one label with a third of all rows."""
    if small:  # many trees, blocks and chunks
        for name, value in (("TREE", 4), ("BLOCK_BYTES", 300), ("CHUNK", 16), ("_BUFFER", 20)):
            monkeypatch.setattr(hard_negatives, name, value)
    rng = np.random.default_rng(int(small))
    rows = [(int(i), int(rng.choice([0, 0, 1, 2, 3])), tuple(rng.integers(-3, 4, size=3 if i % 11 else 2).tolist())) for i in range(240)]
    rows += rows[:30] + [(10, 1, (3, 3, 3)), (10, 0, (3, 3, 3)), (10, 0, (1, 2, 3)), (20, 2, (0, 0, 0)), (500, 9, (1, 1, 1)), (510, 9, (2,))]
    df = spark.createDataFrame(rows, "id long, label int, x array<long>").withColumn("rank", F.lit("x")).repartition(5)
    for most in ((5, 10), (1, 1), (2, 300)):
        got = hard_negatives.mine(df, F.col("id") % 10 == 0, *most)
        assert found(got) == brute(rows, lambda i: i % 10 == 0, *most)
    assert hard_negatives.mine(df.limit(0), F.col("id") % 10 == 0).collect() == []
    assert hard_negatives.mine(df, F.lit(False)).collect() == []


def test_odd_embeddings_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.5]), (1, None), (2, []), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, [None, 1.0]), (6, [0.25, -0.001])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("x", F.lit("other"))
    kept = vectors.whole(df, "embedding", 256, name="whole").collect()
    assert sorted((r["vec_id"], r["whole"]) for r in kept) == [(0, [256, 128]), (6, [64, -1])]


def test_scores_beyond_a_double_are_exact(spark):
    big = 2**29
    rows = [(i, i % 2, (big + i, big - 3 * i, 5 * i)) for i in range(40)]
    df = spark.createDataFrame(rows, "id long, label long, x array<long>")
    want = brute(rows, lambda i: i % 10 == 0, low=30, high=200)
    assert want and found(hard_negatives.mine(df, F.col("id") % 10 == 0, low=30, high=200)) == want


def test_spanning_tree_is_minimal():
    rng = np.random.default_rng(4)
    x = rng.integers(-50, 50, size=(40, 6))
    order, parent, edge = hard_negatives.spanning_tree(x)
    assert sorted(order) == list(range(40)) and (parent[1:] < np.arange(1, 40)).all() and edge[0] == 0
    assert np.allclose(edge[1:], [np.linalg.norm(x[order[k]] - x[order[parent[k]]]) for k in range(1, 40)])
    pairs = sorted((np.linalg.norm(x[a] - x[b]), a, b) for a in range(40) for b in range(a))
    low, total = list(range(40)), 0.0
    root = lambda i: i if low[i] == i else root(low[i])
    for away, a, b in pairs:
        if root(a) != root(b):
            low[root(a)] = root(b)
            total += away
    assert math.isclose(edge.sum(), total)


def searched(x, labels, chosen, windows, same, most):
    order, parent, edge = hard_negatives.spanning_tree(x[chosen])
    at = chosen[order]
    low, high = windows
    tree = hard_negatives.Tree(at, at, labels[at], x[at], parent, edge, low[order], high[order], same, most)
    search = hard_negatives.Search(tree)
    for k in range(0, len(x), 500):
        search.add(np.arange(len(x))[k : k + 500], labels[k : k + 500], x[k : k + 500])
    return search


def test_bounds_spare_work_on_clusters(spark):
    """Anchors in tight clusters: most candidates of a child are told from its parent's scores; random ones are not."""
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(12, 64))
    which = rng.integers(0, 12, size=6000)
    x = np.floor(256 * (centres[which] + 0.03 * rng.normal(size=(6000, 64)))).astype(np.int64)
    labels = which % 10
    chosen = np.arange(0, 6000, 20)
    shares = {}
    for name, data in (("clusters", x), ("random", np.floor(256 * rng.normal(size=x.shape)).astype(np.int64))):
        top = (data[chosen] ** 2).sum(axis=1)[:, None].astype(float)
        search = searched(data, labels, chosen, (np.ceil(0.3 * top).astype(np.int64), np.floor(0.9 * top).astype(np.int64)), False, 10)
        shares[name] = search.rescored / search.met
        got = defaultdict(list)
        for _, anchor, score, ids in search.windows():
            for a, s, i in zip(search.tree.keys[anchor].tolist(), score.tolist(), ids.tolist(), strict=True):
                got[a].append((-s, i))
        for a in chosen[:40]:
            scores, own = data @ data[a], (data[a] ** 2).sum()
            fits = (labels != labels[a]) & (scores >= 0.3 * own) & (scores <= 0.9 * own)
            assert got[int(a)] == sorted((-s, i) for s, i in zip(scores[fits].tolist(), np.flatnonzero(fits).tolist(), strict=True))[:10]
    print(shares)
    assert shares["clusters"] < 0.2 < shares["random"] <= 1
