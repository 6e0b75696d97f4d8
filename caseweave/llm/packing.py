"""Packing of tokenised documents into windows by lexical retrieval.

Documents are placed by content in shards of bounded size: a tree of cuts, learned from a sample of all documents,
keeps those together that share their highest-weight pieces. Each shard has a BM25 index of its pieces; a seed
document asks it for unused neighbours, which greedily fill the seed's window. Word weights come from all documents.
"""

from __future__ import annotations

import json
import math
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .batches import SLICE_BYTES, give_back, slices, take_ragged, tidy
from .pieces import Recent, distinct_pieces, spaced_pieces
from .token_counts import byte_letters

WINDOW = 2048
SHARD_TOKENS = 1_000_000
K1, B = 1.2, 0.75
AXES = 32  # random axes of a sketch
SALT = 1e-3  # scale of the coordinate that tells equal texts apart
SAMPLE = 64  # documents a shard, from which cuts are learned
_CHUNK = 1 << 17


class Vocabulary:
    """A byte-level vocabulary file; special strings inside texts are found as its library finds them."""

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        with open(path) as file:
            held = json.load(file)
        byte_of = {x: b for b, x in enumerate(byte_letters())}
        ranks = {bytes(byte_of[x] for x in token): i for token, i in held["model"]["vocab"].items()
                 if all(x in byte_of for x in token)}
        special = {t["content"] for t in held["added_tokens"]}
        self.ranks = {t: i for t, i in ranks.items() if t.decode("utf-8", "replace") not in special}
        self.size = max([*held["model"]["vocab"].values(), *(t["id"] for t in held["added_tokens"])]) + 1
        self.core = tiktoken.Encoding(
            "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=self.ranks, special_tokens={}
        )
        self.tokenizer = Tokenizer.from_file(path)

    def piece(self, piece: bytes) -> bytes:
        return np.array(self.core._encode_single_piece(piece), "<u4").tobytes()

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


@lru_cache(maxsize=2)
def load_vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def tokenised(
    docs: DataFrame, vocabulary_path: str, end_id: int, id_col: str, text_col: str, slice_bytes: int = SLICE_BYTES
) -> DataFrame:
    """Ids of every whole text with end_id behind them, and, one row a task, in how many texts each id occurs."""
    recent = Recent()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words_of = load_vocabulary(vocabulary_path)
        seen = np.zeros(max(words_of.size, end_id + 1), np.int64)
        kind = None

        def make(words: list[bytes]) -> list[bytes]:
            return [words_of.piece(w[1:]) if w[:1] == b"p" else words_of.whole(w[1:].decode()) for w in words]

        for batch in batches:
            kind = batch.schema.field(0).type
            for first, end, data, bounds in slices(batch.column(1), slice_bytes):
                rows = end - first
                # a text with other characters is one piece, for the library itself
                words, codes, counts = distinct_pieces(data, bounds, spaced_pieces, lambda t: [b"\xff" + t.encode()])
                found = recent.values([b"t" + w[1:] if w[:1] == b"\xff" else b"p" + w for w in words], make)
                found.append(end_id.to_bytes(4, "little"))
                sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
                flat = np.frombuffer(b"".join(found), "<u4")
                starts = np.cumsum(sizes) - sizes
                codes = np.insert(codes, np.cumsum(counts), len(found) - 1)
                ids = flat[take_ragged(starts[codes], sizes[codes])]
                ends = np.concatenate([[0], np.cumsum(sizes[codes])])[np.concatenate([[0], np.cumsum(counts + 1)])]
                owner = np.repeat(np.arange(rows, dtype=np.int64), np.diff(ends))
                both = np.sort(owner << 32 | ids)
                once = both[np.append(True, both[1:] != both[:-1])] & 0xFFFFFFFF
                seen += np.bincount(once, minlength=len(seen))
                small = ids.astype("<u2") if words_of.size <= 1 << 16 and end_id < 1 << 16 else ids
                offsets = (ends * small.itemsize).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, rows),
                        pa.array(np.diff(ends)),
                        pa.Array.from_buffers(
                            pa.binary(), rows, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(small.tobytes())]
                        ),
                        pa.nulls(rows, pa.binary()),
                    ],
                    names=[id_col, "n", "ids", "seen"],
                )
        if kind is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(1, kind), pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()), pa.array([seen.tobytes()])],
                names=[id_col, "n", "ids", "seen"],
            )

    schema = f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, n bigint, ids binary, seen binary"
    return docs.select(id_col, text_col).mapInArrow(tidy(run), schema)


def _in_documents(table: DataFrame) -> np.ndarray:
    """In how many documents each id occurs: summed on the executors, one number an id of the vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for value in batch.column(0):
                own = np.frombuffer(value.as_buffer(), np.int64)
                total = own if total is None else total + own
        if total is not None:
            hit = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(hit), pa.array(total[hit])], names=["id", "n"])

    parts = table.filter("seen is not null").select("seen").mapInArrow(tidy(run), "id bigint, n bigint")
    sums = parts.groupBy("id").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(int(sums["id"].max()) + 1 if len(sums) else 1, np.int64)
    out[sums["id"].to_numpy(np.int64)] = sums["n"].to_numpy(np.int64)
    return out


class Index:
    """BM25 over the pieces of one shard."""

    def __init__(self, pieces: list[np.ndarray], weight: np.ndarray):
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        owner = np.repeat(np.arange(len(pieces), dtype=np.int64), lengths)
        both = np.sort(owner << 32 | np.concatenate(pieces).astype(np.int64))
        heads = np.flatnonzero(np.append(True, both[1:] != both[:-1]))
        tf = np.diff(np.append(heads, len(both)))
        piece, self.terms = both[heads] >> 32, both[heads] & 0xFFFFFFFF
        self.edges = np.searchsorted(piece, np.arange(len(pieces) + 1))
        norm = K1 * (1 - B + B * lengths / lengths.mean())
        score = (weight[self.terms] * tf * (K1 + 1) / (tf + norm[piece])).astype(np.float32)
        order = np.argsort(self.terms, kind="stable")
        self.piece, self.score = piece[order], score[order]
        self.first = np.searchsorted(self.terms[order], np.arange(int(self.terms.max()) + 2))
        self.count = len(pieces)

    def scores(self, seed: int) -> np.ndarray:
        """Score of every piece of the shard for the distinct terms of the seed."""
        terms = self.terms[self.edges[seed] : self.edges[seed + 1]]
        starts = self.first[terms]
        at = take_ragged(starts, self.first[terms + 1] - starts)
        return np.bincount(self.piece[at], self.score[at], minlength=self.count)


@lru_cache(maxsize=1)
def _axes(size: int) -> np.ndarray:
    return np.random.default_rng(1).standard_normal((size, AXES), np.float32)


def sketches(pieces: list[np.ndarray], salt: np.ndarray, weight: np.ndarray, mean: float) -> np.ndarray:
    """For each piece its BM25 term scores on random axes, scaled to length 1, and one more coordinate from its salt.

    A piece's sketch does not depend on the others. salt: numbers in [0, 1).
    """
    axes = _axes(len(weight))
    out = np.zeros((len(pieces), AXES + 1), np.float32)
    out[:, AXES] = SALT * salt
    lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
    ends = np.cumsum(lengths)
    lo = 0
    while lo < len(pieces):
        hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] - lengths[lo] + _CHUNK, "right")))
        own = lengths[lo:hi]
        owner = np.repeat(np.arange(hi - lo, dtype=np.int64), own)
        both = np.sort(owner << 32 | np.concatenate(pieces[lo:hi]).astype(np.int64))
        heads = np.flatnonzero(np.append(True, both[1:] != both[:-1])[: len(both)])
        tf = np.diff(np.append(heads, len(both)))
        piece, terms = both[heads] >> 32, both[heads] & 0xFFFFFFFF
        norm = K1 * (1 - B + B * own / mean)
        score = (weight[terms] * tf * (K1 + 1) / (tf + norm[piece])).astype(np.float32)
        full = np.flatnonzero(own)
        if len(full):
            sums = np.add.reduceat(axes[terms] * score[:, None], np.searchsorted(piece, full))
            long = np.sqrt((sums * sums).sum(axis=1, keepdims=True))
            out[lo + full, :AXES] = sums / np.maximum(long, np.float32(1e-9))
        lo = hi
    return out


class Cuts:
    """A tree that cuts the space of sketches into shards of about equal numbers of tokens.

    Each cut is across the direction in which the sample below it is widest. Copies of one text differ only in
    their salt, so cuts among them go by it and no shard holds them all.
    """

    def __init__(self, sample: np.ndarray, tokens: np.ndarray, shards: int):
        self.way = np.zeros((max(1, shards - 1), sample.shape[1]), np.float32)
        self.edge = np.full(max(1, shards - 1), np.inf, np.float32)
        self.next = np.full((max(1, shards - 1), 2), -1, np.int64)  # a cut, or -1 - shard
        free, named = iter(range(shards)), iter(range(shards))
        waiting = [(np.arange(len(sample)), shards, None)]
        while waiting:
            rows, share, parent = waiting.pop()
            node = next(free) if share > 1 else -1 - next(named)
            if parent:
                self.next[parent] = node
            if share == 1:
                continue
            half = share // 2
            below = above = rows
            if len(rows):
                apart = sample[rows].astype(np.float64)
                apart -= apart.mean(axis=0)
                self.way[node] = np.linalg.eigh(apart.T @ apart)[1][:, -1]
                at = self.along(sample[rows], np.full(len(rows), node))
                order = np.argsort(at, kind="stable")
                upto = np.cumsum(tokens[rows][order])
                self.edge[node] = at[order[min(int(np.searchsorted(upto, upto[-1] * half / share)), len(rows) - 1)]]
                below, above = rows[at <= self.edge[node]], rows[at > self.edge[node]]
            waiting += [(below, half, (node, 0)), (above, share - half, (node, 1))]

    def along(self, found: np.ndarray, node: np.ndarray) -> np.ndarray:
        return (found * self.way[node]).sum(axis=1)

    def shard(self, found: np.ndarray) -> np.ndarray:
        node = np.zeros(len(found), np.int64)
        while (open_ := np.flatnonzero(node >= 0)).size:
            own = node[open_]
            node[open_] = self.next[own, (self.along(found[open_], own) > self.edge[own]).astype(np.int64)]
        return -1 - node


def _unpacked(ids: pa.Array, n: np.ndarray) -> list[np.ndarray]:
    buffers = [ids[i].as_buffer() for i in range(len(n))]
    return [np.frombuffer(b, "<u2" if b.size == 2 * k else "<u4") for b, k in zip(buffers, n.tolist(), strict=True)]


def _by_content(rows: DataFrame, id_col: str, held, mean: float, window: int, shards: int, texts: int) -> DataFrame:
    """The rows with their shard: what a row has beyond a multiple of `window` decides."""
    mark = F.xxhash64(F.col(id_col), F.crc32("ids"), F.col("n"))
    salted = rows.withColumn("salt", F.pmod(mark, F.lit(1 << 24)) / (1 << 24))

    def found(batch: pa.RecordBatch) -> np.ndarray:
        ids = _unpacked(batch.column("ids"), n := batch.column("n").to_numpy())
        tails = [own[k // window * window :] for own, k in zip(ids, n.tolist(), strict=True)]
        return sketches(tails, batch.column("salt").to_numpy(), held.value, mean)

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [x.tobytes() for x in found(batch)]
            yield pa.RecordBatch.from_arrays([batch.column("n"), pa.array(parts, pa.binary())], names=["n", "sketch"])

    # rows of the sample by another hash than their salt; on the driver about 150 bytes each
    rate = min(1.0, SAMPLE * shards / max(1, texts))
    chosen = salted.filter(F.pmod(F.xxhash64(mark), F.lit(1 << 24)) < F.lit(int(rate * (1 << 24))))
    sample = chosen.select("n", "ids", "salt").mapInArrow(tidy(learn), "n bigint, sketch binary").toPandas()
    sample = sample.sort_values(["sketch", "n"], kind="stable")
    points = np.frombuffer(b"".join(map(bytes, sample["sketch"])), np.float32).reshape(-1, AXES + 1)
    cuts = rows.sparkSession.sparkContext.broadcast(Cuts(points, sample["n"].to_numpy(np.int64), shards))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shard = pa.array(cuts.value.shard(found(batch)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], shard], names=[id_col, "n", "ids", "shard"])

    kind = rows.schema[id_col].dataType.simpleString()
    return salted.mapInArrow(tidy(place), f"`{id_col}` {kind}, n bigint, ids binary, shard bigint")


def _next_fit(sizes: np.ndarray, at: int, room: int) -> int:
    """The first place from `at` on that holds at most `room`, or the number of places. Looks ahead in growing steps."""
    step = 64
    while at < len(sizes):
        fits = sizes[at : at + step] <= room
        if fits[k := int(np.argmax(fits))]:
            return at + k
        at, step = at + step, step * 2
    return len(sizes)


def fill_windows(lengths: np.ndarray, scores, window: int) -> Iterator[list[tuple[int, int]]]:
    """Windows as lists of (piece, tokens of it taken from what is left of it).

    The longest piece left is the seed. Its best-scored neighbours follow, first those that fit whole; when
    none fits, the best one is cut. So every window but the last is full. Scores are 0 or more. What did not fit once
    does not fit later, as room only shrinks: a window is one walk over the pieces left, however many it takes in.
    """
    left = lengths.copy()
    while left.any():
        seed = int(np.argmax(left))
        room = window - int(left[seed])
        out = [(seed, int(left[seed]))]
        left[seed] = 0
        if room:
            found = scores(seed)
            near, far = np.flatnonzero((found > 0) & (left > 0)), np.flatnonzero((found <= 0) & (left > 0))
            order = np.concatenate([near[np.argsort(-found[near], kind="stable")], far])
            sizes = left[order]
            at = _next_fit(sizes, 0, room)
            while room and at < len(order):
                out.append((int(order[at]), int(sizes[at])))
                room -= int(sizes[at])
                left[order[at]] = 0
                at = _next_fit(sizes, at + 1, room)
            if room and len(rest := order[left[order] > 0]):
                out.append((int(rest[0]), room))
                left[rest[0]] -= room
        yield out


def pack(
    docs: DataFrame,
    vocabulary_path: str,
    end_id: int = 1,
    window: int = WINDOW,
    shard_tokens: int = SHARD_TOKENS,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = False,
    slice_bytes: int = SLICE_BYTES,
) -> DataFrame:
    """Pieces of all documents, packed into sequences of at most `window` tokens.

    Columns: id_col, start, length, ids_crc32, doc_tokens, sequence_id, offset, and ids (little-endian) if asked
    for. A null or empty text is the end id alone. Repeated rows are packed as often as they occur; a null id is
    packed like any other. What a document has beyond a multiple of `window` goes to its shard's index. Each
    shard leaves at most one sequence that is not full. Neighbours come from the seed's shard, which holds the texts
    most like it of all documents; the README says how many of the global best are among them.

    slice_bytes: bytes of text that a task tokenises at once. A Python worker takes about 25 times as much beside its
    vocabulary; smaller slices meet more pieces anew and cost more time. The result does not depend on it.
    """
    table = cut_lineage(tokenised(docs, vocabulary_path, end_id, id_col, text_col, slice_bytes))
    rows = table.filter("ids is not null").select(id_col, "n", "ids")
    total = rows.agg(
        F.sum("n").alias("tokens"), F.count(F.lit(1)).alias("docs"), F.avg(F.col("n") % window).alias("mean")
    ).first()
    seen, texts = _in_documents(table), total["docs"]
    weight = np.log1p((texts - seen + 0.5) / (seen + 0.5)).astype(np.float32)
    held = docs.sparkSession.sparkContext.broadcast(weight)  # one number an id of the vocabulary
    shards = max(1, math.ceil((total["tokens"] or 0) / shard_tokens))
    names = [id_col, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] + ["ids"] * with_ids
    kind = docs.schema[id_col].dataType.simpleString()
    fields = f"`{id_col}` {kind}, " + ", ".join(f"{n} bigint" for n in names[1:7]) + ", ids binary" * with_ids

    def packed(group: pa.Table) -> pa.Table:
        group = group.combine_chunks().sort_by([(id_col, "ascending"), ("n", "ascending"), ("ids", "ascending")])
        ids_col = group.column("ids").combine_chunks()
        n = group.column("n").to_numpy()
        shard = group.column("shard")[0].as_py()
        ids = _unpacked(ids_col, n)
        out: list[tuple[int, int, int, int, int]] = []  # row, start, length, sequence, offset
        sequence = shard << 32
        tails, where = [], []
        for row, own in enumerate(ids):
            whole = len(own) // window * window
            for start in range(0, whole, window):
                out.append((row, start, window, sequence, 0))
                sequence += 1
            if len(own) > whole:
                tails.append(own[whole:])
                where.append([row, whole])
        if tails:
            index = Index(tails, held.value)
            for filled in fill_windows(np.array([len(t) for t in tails]), index.scores, window):
                offset = 0
                for piece, take in filled:
                    row, start = where[piece]
                    out.append((row, start, take, sequence, offset))
                    where[piece][1] += take
                    offset += take
                sequence += 1
        rows_, starts, lengths, sequences, offsets = np.array(out, np.int64).T
        parts = [ids[r][s : s + k].astype("<u4").tobytes() for r, s, k, _, _ in out]
        columns = [group.column(id_col).take(pa.array(rows_)), starts, lengths, [zlib.crc32(p) for p in parts],
                   n[rows_], sequences, offsets]
        columns = [columns[0], *(pa.array(c, pa.int64()) for c in columns[1:])]
        return pa.Table.from_arrays(columns + [pa.array(parts, pa.binary())] * with_ids, names=names)

    def run(group: pa.Table) -> pa.Table:
        out = packed(group)
        give_back()
        return out

    if shards == 1:
        placed = rows.withColumn("shard", F.lit(0).cast("bigint"))
    else:
        placed = _by_content(rows, id_col, held, max(1.0, total["mean"]), window, shards, texts)
    return placed.groupBy("shard").applyInArrow(run, fields)
