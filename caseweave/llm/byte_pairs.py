"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

Linked-list positions wait in one bucket for each merge rank. A two-level bitmap marks the buckets that hold
something, so that find-first-set gives the next rank at once; entries that a later merge made stale are
skipped. One long piece of n bytes takes O(n log n). The short pieces of a batch share one queue: no pair
reaches into another piece, so each bucket is worked off for all pieces at once.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .batches import slices, take_ragged
from .pieces import Recent, distinct_pieces, spaced_pieces

_LEAF = 8  # ranks of one leaf of the bitmap: 2 ** 8
_LONG = 128  # bytes from which a piece has a queue of its own; the ids are the same either way
_NONE = np.iinfo(np.int32).max


@lru_cache(maxsize=4)
def load_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a file with one base64 token and its rank a line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


def merge_piece(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one piece: always the pair of lowest rank is merged, of equals the leftmost."""
    if (whole := ranks.get(piece)) is not None:
        return [whole]
    n = len(piece)
    after = list(range(1, n + 1)) + [n]  # where the token that starts here ends
    before = list(range(-1, n))
    want = [-1] * n  # rank under which a position waits; another rank met in a bucket is stale
    buckets: dict[int, list[int]] = {}
    leaves: dict[int, int] = {}
    top = 0
    for i in range(n - 1):
        if (r := ranks.get(piece[i : i + 2])) is not None:
            want[i] = r
            if r in buckets:
                buckets[r].append(i)  # in order, so already a heap
            else:
                buckets[r] = [i]
                leaves[r >> _LEAF] = leaves.get(r >> _LEAF, 0) | 1 << (r & 255)
                top |= 1 << (r >> _LEAF)
    while top:
        leaf = (top & -top).bit_length() - 1
        bits = leaves[leaf]
        low = (bits & -bits).bit_length() - 1
        rank = leaf << _LEAF | low
        bucket = buckets[rank]
        while bucket:
            i = heappop(bucket)
            if want[i] != rank:
                continue
            middle = after[i]
            end = after[middle]
            want[middle] = -1
            after[i] = end
            if end < n:
                before[end] = i
            lower = False
            for p in (before[i], i):
                if p < 0:
                    continue
                stop = after[after[p]] if after[p] < n else 0
                r = ranks.get(piece[p:stop]) if stop else None
                if r is None:
                    want[p] = -1
                    continue
                want[p] = r
                if r == rank:
                    heappush(bucket, p)
                    continue
                if r in buckets:
                    heappush(buckets[r], p)
                else:
                    buckets[r] = [p]
                    leaves[r >> _LEAF] = leaves.get(r >> _LEAF, 0) | 1 << (r & 255)
                    top |= 1 << (r >> _LEAF)
                lower |= r < rank
            if lower:
                break
        if not bucket:
            del buckets[rank]
            bits = leaves[leaf] & ~(1 << low)
            leaves[leaf] = bits
            if not bits:
                top &= ~(1 << leaf)
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : after[i]]])
        i = after[i]
    return out


class Ranks:
    """A rank file and, as sorted arrays, every pair of tokens that together are a token."""

    def __init__(self, path: str):
        self.ranks = load_ranks(path)
        self.size = max(self.ranks.values()) + 1
        self.byte = np.array([self.ranks[bytes([b])] for b in range(256)], np.int64)
        pairs = [
            (self.ranks[token[:k]] * (self.size + 1) + self.ranks[token[k:]], rank)
            for token, rank in self.ranks.items()
            for k in range(1, len(token))
            if token[:k] in self.ranks and token[k:] in self.ranks
        ]
        keys, made = np.array(pairs, np.int64).reshape(-1, 2).T
        order = np.argsort(keys)
        self.keys, self.made = np.append(keys[order], np.iinfo(np.int64).max), np.append(made[order], 0)

    def lookup(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * (self.size + 1) + right
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.made[at], _NONE)

    def encode(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of each piece as little-endian unsigned 32-bit integers."""
        out: list[bytes | None] = [None] * len(pieces)
        short = []
        for i, piece in enumerate(pieces):
            if (whole := self.ranks.get(piece)) is not None:
                out[i] = whole.to_bytes(4, "little")
            elif len(piece) > _LONG:
                out[i] = np.array(merge_piece(piece, self.ranks), "<u4").tobytes()
            else:
                short.append(i)
        for i, ids in zip(short, self._merge([pieces[i] for i in short]), strict=True):
            out[i] = ids
        return out

    def _merge(self, pieces: list[bytes]) -> list[bytes]:
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        n = int(sizes.sum())
        piece = np.repeat(np.arange(len(pieces)), sizes)
        # slot n stands before the first and behind the last token of every piece; no pair holds it
        ids = np.append(self.byte[np.frombuffer(b"".join(pieces), np.uint8)], self.size)
        after, before = np.arange(1, n + 2), np.arange(-1, n)
        ends = np.cumsum(sizes)
        after[ends - 1] = n
        before[ends - sizes] = n
        want = np.full(n + 1, _NONE)
        want[:n] = self.lookup(ids[:n], ids[after[:n]])
        buckets: dict[int, list[np.ndarray]] = {}
        leaves = [0] * ((self.size >> _LEAF) + 1)
        top = 0

        def put(positions: np.ndarray, ranks: np.ndarray) -> None:
            nonlocal top
            order = np.argsort(ranks, kind="stable")
            ranks = ranks[order]
            heads = np.flatnonzero(np.append(True, ranks[1:] != ranks[:-1])) if len(ranks) else ranks
            for r, part in zip(ranks[heads].tolist(), np.split(positions[order], heads[1:]), strict=False):
                if (bucket := buckets.get(r)) is not None:
                    bucket.append(part)
                else:
                    buckets[r] = [part]
                    leaves[r >> _LEAF] |= 1 << (r & 255)
                    top |= 1 << (r >> _LEAF)

        first = np.flatnonzero(want < _NONE)
        put(first, want[first])
        while top:
            leaf = (top & -top).bit_length() - 1
            bits = leaves[leaf]
            low = bits & -bits
            rank = leaf << _LEAF | low.bit_length() - 1
            leaves[leaf] = bits ^ low
            if bits == low:
                top &= ~(1 << leaf)
            at = np.sort(np.concatenate(buckets.pop(rank)))
            at = at[(want[at] == rank) & np.append(True, at[1:] != at[:-1])]
            if not len(at):
                continue
            if len(at) > 1:  # the leftmost pair of a piece first, the others after what it gives rise to
                own = piece[at]
                lead = np.append(True, own[1:] != own[:-1])
                if not lead.all():
                    put(at[~lead], np.full(int((~lead).sum()), rank))
                    at = at[lead]
            middle = after[at]
            end = after[middle]
            ids[at] = rank
            want[middle] = _NONE
            after[at] = end
            before[end] = at
            left = before[at]
            pos = np.concatenate([left, at])
            new = self.lookup(ids[pos], ids[np.concatenate([at, end])])
            want[pos] = new
            found = new < _NONE
            put(pos[found], new[found])
        return self._read(ids, after, ends - sizes, n)

    @staticmethod
    def _read(ids: np.ndarray, after: np.ndarray, heads: np.ndarray, n: int) -> list[bytes]:
        """Walk all pieces' lists at the same time, one token a round."""
        order, level, at, who = [], [], heads, np.arange(len(heads))
        while len(at):
            order.append(who)
            level.append(ids[at])
            at = after[at]
            going = at < n
            at, who = at[going], who[going]
        owner = np.concatenate(order) if order else np.empty(0, np.int64)
        sort = np.argsort(owner, kind="stable")
        flat = np.concatenate(level)[sort].astype("<u4").tobytes() if level else b""
        ends = np.cumsum(np.bincount(owner, minlength=len(heads))) * 4
        return [flat[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)] if len(heads) else []


@lru_cache(maxsize=2)
def ranks_of(path: str) -> Ranks:
    return Ranks(path)


def encode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Ids of every whole text: id_col and `ids`, little-endian unsigned 32-bit integers.

    A null or empty text has no ids. Repeated rows give repeated results; an empty table an empty one. No other
    column is read. ranks_path must be readable on the executors. No string is special.
    """
    recent = Recent()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = ranks_of(ranks_path)
        split = regex.compile(pattern)

        def exact(text: str) -> list[bytes]:
            return [piece.encode() for piece in split.findall(text)]

        for batch in batches:
            for first, end, data, bounds in slices(batch.column(1)):
                words, codes, counts = distinct_pieces(data, bounds, spaced_pieces, exact)
                ids = recent.values(words, ranks.encode)
                sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
                flat = np.frombuffer(b"".join(ids), "<u4")
                starts = np.cumsum(sizes) - sizes
                every = flat[take_ragged(starts[codes], sizes[codes])]
                ends = np.concatenate([[0], np.cumsum(sizes[codes])])[np.concatenate([[0], np.cumsum(counts)])]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, end - first), _binaries(every, ends)], names=[id_col, "ids"]
                )

    schema = f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, ids binary"
    return docs.select(id_col, text_col).mapInArrow(run, schema)


def decode(encoded: DataFrame, ranks_path: str, id_col: str = "doc_id") -> DataFrame:
    """The bytes that ids stand for: the columns of `encoded` and `decoded`; null ids give null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = load_ranks(ranks_path)
        size = max(ranks.values(), default=-1) + 1
        tokens = [b""] * size
        for token, rank in ranks.items():
            tokens[rank] = token
        lengths = np.fromiter(map(len, tokens), np.int64, size)
        table = np.frombuffer(b"".join(tokens), np.uint8)
        starts = np.cumsum(lengths) - lengths
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index("ids"))
            for at in range(0, len(ids), 512):
                part = ids.slice(at, 512)
                decoded = []
                for value in part:
                    if value.as_py() is None:
                        decoded.append(None)
                        continue
                    own = np.frombuffer(value.as_buffer(), "<u4")
                    decoded.append(table[take_ragged(starts[own], lengths[own])].tobytes())
                yield pa.RecordBatch.from_arrays(
                    [*(c.slice(at, 512) for c in batch.columns), pa.array(decoded, pa.binary())],
                    names=[*batch.schema.names, "decoded"],
                )

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema)
    return encoded.mapInArrow(run, f"{fields}, decoded binary")


def _binaries(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """values[ends[i]:ends[i + 1]] of each row as its bytes."""
    offsets = (ends * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(
        pa.binary(), len(ends) - 1, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(values.tobytes())]
    )
