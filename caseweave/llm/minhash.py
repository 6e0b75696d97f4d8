"""Near-duplicate documents by circulant MinHash, banding and exact verification.

Two permutations make all coordinates of a signature: the first scatters the shingles, the second, shifted
circularly by k places, gives coordinate k. Bands of coordinates propose pairs; a pair is a link only if the
full shingle sets confirm it.
"""

from __future__ import annotations

import hashlib
import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .batches import slices, tidy
from .components import components
from .words import Words, mixed

BANDS, ROWS = 30, 6  # a pair at 0.85 is missed by all bands once in a million, at 0.9 once in 10 ** 10
MISSED = 1e-6  # most often that all bands miss a pair that is just similar enough
_WORDS = 1 << 18  # rows of the bitmap of ids that is broadcast
_U = np.uint32
_CHUNK = 1 << 16


def layout(percent: int) -> tuple[int, int]:
    """Bands and rows for a threshold: the most rows for which as many coordinates as at 85 are enough for MISSED.

    Below 8 percent even one row needs more coordinates, and gets them.
    """
    fits = [(1, 1)]
    for rows in range(1, ROWS + 1):
        alike = min((percent / 100) ** rows, 1 - MISSED)
        bands = math.ceil(math.log(MISSED) / math.log1p(-alike))
        if rows == 1 or bands * rows <= BANDS * ROWS:
            fits.append((bands, rows))
    return fits[-1]


def _permuted(x: np.ndarray) -> np.ndarray:
    """A fixed permutation of 32-bit integers, in place."""
    x ^= x >> _U(16)
    x *= _U(0x85EBCA6B)
    x ^= x >> _U(13)
    x *= _U(0xC2B2AE35)
    x ^= x >> _U(16)
    return x


def signatures(shingles: np.ndarray, bounds: np.ndarray, size: int) -> np.ndarray:
    """`size` coordinates for each text with shingles[bounds[i]:bounds[i + 1]]; all ones where that is empty."""
    out = np.full((len(bounds) - 1, size), 0xFFFFFFFF, _U)
    scattered = _permuted((shingles >> np.uint64(32)).astype(_U) ^ _U(0x5BD1E995))
    full = np.flatnonzero(bounds[1:] > bounds[:-1])
    lo = 0
    while lo < len(full):
        # texts of about one chunk together, so that the work stays in cache
        hi = max(lo + 1, int(np.searchsorted(bounds[full + 1], bounds[full[lo]] + _CHUNK)))
        base = bounds[full[lo]]
        part = scattered[base : bounds[full[hi - 1] + 1]]
        heads = bounds[full[lo:hi]] - base
        for k in range(size):
            out[full[lo:hi], k] = np.minimum.reduceat(_permuted(part - _U(k)), heads)
        lo = hi
    return out


def _sorted_sets(shingles: np.ndarray, bounds: np.ndarray) -> Iterator[np.ndarray]:
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        yield np.unique(shingles[a:b])


def sketch(docs: DataFrame, id_col: str, text_col: str, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """For each row: node (its id), n_shingles, digest of the shingle set, and the hashes of its bands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, bounds in slices(batch.column(1), 1 << 20):
                shingles, edges = Words(data, bounds).shingles()
                made = signatures(shingles, edges, bands * rows).astype(np.uint64)
                keys = np.zeros((end - first, bands), np.uint64)
                for k in range(rows):
                    keys = mixed(keys ^ made[:, k::rows]) + np.uint64(0x9E3779B97F4A7C15)
                keys = mixed(keys + np.arange(bands, dtype=np.uint64))
                sets = list(_sorted_sets(shingles, edges))
                offsets = pa.array(np.arange(0, (end - first + 1) * bands, bands, dtype=np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, end - first),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                        pa.ListArray.from_arrays(offsets, pa.array(keys.view(np.int64).ravel())),
                    ],
                    names=["node", "n_shingles", "digest", "bands"],
                )

    schema = "node bigint, n_shingles bigint, digest binary, bands array<bigint>"
    return docs.select(F.col(id_col).cast("long").alias("node"), text_col).mapInArrow(tidy(run), schema)


def shingle_sets(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """node and its full set of shingle hashes, ascending."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, bounds in slices(batch.column(1), 1 << 20):
                sets = list(_sorted_sets(*Words(data, bounds).shingles()))
                ends = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
                values = np.concatenate(sets).view(np.int64) if sets else np.empty(0, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, end - first),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(values)),
                    ],
                    names=["node", "shingles"],
                )

    return docs.select(F.col(id_col).cast("long").alias("node"), text_col).mapInArrow(
        tidy(run), "node bigint, shingles array<bigint>"
    )


def marked(rows: DataFrame, node, nodes: DataFrame) -> DataFrame:
    """The rows, in place and without a shuffle, with `__hit`: is their node (a long) in nodes, or of equal hash?

    What is broadcast is a bitmap of hashes: at most `_WORDS` rows of 64 bits, however many nodes there are. With
    more nodes than it has bits it lets more rows through, so the caller joins those exactly afterwards.
    """
    place_of = lambda x: F.pmod(F.xxhash64(x), F.lit(64 * _WORDS))
    word, bit = F.shiftright("__place", 6), F.expr("shiftleft(1L, cast(__place & 63 as int))")
    bits = nodes.select(place_of(F.col("node")).alias("__place"))
    bits = bits.groupBy(word.alias("__word")).agg(F.bit_or(bit).alias("__bits"))
    placed = rows.withColumn("__place", place_of(node)).withColumn("__word", word)
    found = placed.join(F.broadcast(bits), "__word", "left")
    return found.select(
        *(F.col(f"`{c}`") for c in rows.columns), (F.coalesce("__bits", F.lit(0)).bitwiseAND(bit) != 0).alias("__hit")
    )


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full shingle sets have 100 * intersection >= percent * union."""
    sizes = sets.select("node", F.size("shingles").alias("n"))
    sized = (
        pairs.join(sizes.select(F.col("node").alias("a"), F.col("n").alias("na")), "a")
        .join(sizes.select(F.col("node").alias("b"), F.col("n").alias("nb")), "b")
        .filter(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))  # else the sizes alone forbid it
        .select("a", "b")
        .distinct()
    )
    common = F.size(F.array_intersect("sa", "sb"))
    return (
        sized.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa")), "a")
        .join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb")), "b")
        .filter(100 * common >= percent * (F.size("sa") + F.size("sb") - common))
        .select("a", "b")
    )


def _open(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Members of buckets whose nodes are not all in one component yet, with their labels."""
    named = members.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    apart = named.groupBy("bucket").agg((F.min("label") < F.max("label")).alias("apart")).filter("apart")
    return named.join(apart.select("bucket"), "bucket")


def _rarest(sets: DataFrame, percent: int) -> DataFrame:
    """Buckets of the nodes that share one of their rarest shingles: bucket, node, n and short.

    A set of n shingles that is linked to one of m shares at least t = percent / (100 + percent) * (n + m) with
    it. So, in one order of all shingles (rarest first), both have a common shingle among their first n - t + 1
    and m - t + 1. `short` marks shingles that come early enough for partners as large or larger; the others
    serve for smaller partners, and stand in the buckets of the size classes for which they come early enough.
    """
    every = sets.select("node", F.explode("shingles").alias("s"))
    counts = every.groupBy("s").agg(F.count(F.lit(1)).alias("df"))
    ordered = every.join(counts, "s").groupBy("node").agg(F.array_sort(F.collect_list(F.struct("df", "s"))).alias("o"))
    n, p = F.col("n"), F.col("p")
    least = F.ceil(n * percent / 100).cast("int")
    kept = ordered.select("node", F.size("o").alias("n"), "o").select(
        "node", "n", F.posexplode(F.slice("o", F.lit(1), n - least + 1)).alias("p", "o")
    )
    kept = kept.filter("o.df > 1").select("node", "n", "p", "o.s")
    most = F.least(n, (F.floor((n - p) * (100 + percent) / percent) - n).cast("int"))
    size_class = lambda size: F.floor(F.log(size.cast("double")) / math.log(1.02)).cast("int")
    short = p <= n - F.ceil(2 * n * percent / (100 + percent))
    classes = F.when(most >= least, F.sequence(size_class(least), size_class(most)))
    early = kept.filter(short).select("s", size_class(n).alias("c"), "node", "n", F.lit(True).alias("short"))
    late = kept.select("s", F.explode(classes).alias("c"), "node", "n", F.lit(False).alias("short"))
    both = early.union(late).groupBy(F.xxhash64("s", "c").alias("bucket"), "node", "n")
    return both.agg(F.max("short").alias("short"))


def _apart(centres: DataFrame, members: DataFrame) -> DataFrame:
    """Pairs of a centre and a member of its bucket that are in different components and may be linked."""
    left = centres.select("bucket", *(F.col(c).alias(f"c_{c}") for c in ("node", "n", "short", "label")))
    fits = (F.col("c_short") & (F.col("c_n") <= F.col("n"))) | (F.col("short") & (F.col("n") <= F.col("c_n")))
    both = members.join(left, "bucket").filter((F.col("label") != F.col("c_label")) & fits)
    return both.select(F.least("node", "c_node").alias("a"), F.greatest("node", "c_node").alias("b")).distinct()


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    percent: int = 85,
    bands: int | None = None,
    rows: int | None = None,
) -> DataFrame:
    """Components of documents linked at `percent` Jaccard similarity of their sets of five-word shingles.

    One row for each input row: id_col, n_shingles, component_id (smallest id reachable) and kept (it is its
    component's smallest). Null or empty texts and texts without words have no shingle and no link. Rows that
    share an id are one document. A null id has no component and is kept. Ids must fit a long. An empty table
    gives an empty one; other columns are not read.

    Without bands and rows, layout gives those of the threshold. Equal sets are one node. In every band bucket the node that shares most buckets is the centre and is compared
    with all others, so a group of m copies makes m - 1 pairs, not m * m. Where these others are then not yet in
    one component, their nodes are dealt anew into buckets of their rarest shingles, which any two
    linked sets share: copies far from a centre differ from each other in rare shingles and hardly ever meet.
    Centres are compared as long as that finds links; then every node outside its bucket's largest component is
    compared with all of its bucket that are not in its own, so no two nodes stay both uncompared and apart.
    """
    fit = layout(percent)
    sketched = cut_lineage(sketch(docs, id_col, text_col, bands or fit[0], rows or fit[1]))
    known = sketched.filter("node is not null and n_shingles > 0")
    nodes = known.groupBy("digest").agg(F.min("node").alias("rep"), F.first("bands").alias("bands"))
    nodes = cut_lineage(nodes)
    exploded = nodes.select(F.explode("bands").alias("bucket"), F.col("rep").alias("node")).distinct()
    shared = exploded.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    members = cut_lineage(exploded.join(shared, "bucket"))
    weights = members.groupBy("node").agg(F.sum("n").alias("weight"))
    texts = docs.select(F.col(id_col).cast("long").alias("node"), F.col(text_col).alias("text"))
    # texts stay where they are; only shingle sets are shuffled
    near = marked(texts.filter("node is not null"), F.col("node"), weights.select("node")).filter("__hit")
    sets = shingle_sets(near.select("node", "text"), "node", "text")
    sets = cut_lineage(sets.join(weights.select("node"), "node", "left_semi").distinct())
    centre = F.max_by("node", F.struct("weight", -F.col("node")))
    chosen = members.join(weights, "node").groupBy("bucket").agg(centre.alias("centre"))
    others = cut_lineage(members.join(chosen, "bucket").filter("node <> centre").select("bucket", "node", "centre"))
    pairs = others.select(F.least("node", "centre").alias("a"), F.greatest("node", "centre").alias("b")).distinct()
    # rows of one id with different texts are one document
    same = known.join(nodes.select("digest", "rep"), "digest").filter("node <> rep").select(
        F.col("node").alias("a"), F.col("rep").alias("b")
    )
    links = cut_lineage(same.distinct().union(_confirmed(pairs, sets, percent)))
    labels = components(links)
    left = _open(others.select("bucket", "node"), labels).select("node").distinct()
    sets = cut_lineage(sets.join(left, "node", "left_semi"))
    members = cut_lineage(_rarest(sets, percent))
    for turn in itertools.count():
        left = cut_lineage(_open(members, labels))
        if not left.limit(1).count():
            break
        if last := turn > 0 and not merged:
            sizes = left.groupBy("bucket", "label").agg(F.count(F.lit(1)).alias("k"))
            largest = sizes.groupBy("bucket").agg(F.max_by("label", F.struct("k", "label")).alias("largest"))
            centres = left.join(largest, "bucket").filter("label <> largest")
        else:
            one = left.groupBy("bucket").agg(F.min_by("node", F.xxhash64("node", F.lit(turn))).alias("node"))
            centres = left.join(one, ["bucket", "node"])
        found = cut_lineage(_confirmed(_apart(centres, left), sets, percent))
        merged = bool(found.limit(1).count())
        if merged:
            links = cut_lineage(links.union(found))
            labels = components(links)
        if last:
            break
    component = F.coalesce("label", "node")
    return (
        sketched.join(labels, "node", "left")
        .select(
            F.col("node").cast(docs.schema[id_col].dataType).alias(id_col),
            "n_shingles",
            component.alias("component_id"),
            F.coalesce(F.col("node") == component, F.lit(True)).alias("kept"),
        )
    )
