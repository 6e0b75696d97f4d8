"""Token counts by rank-synchronous merging.

The distinct pieces of a batch lie side by side in one ragged array of symbols. In each round every sequence
has its own lowest-rank pair merged, all sequences at the same time; what is left at the end are the tokens.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .batches import slices, sums_between
from .pieces import Recent, bare_pieces, distinct_pieces

_NONE = np.iinfo(np.int32).max


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in a byte-level vocabulary."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return [chr(b) if b in own else chr(256 + rest.index(b)) for b in range(256)]


class Merges:
    """Merge table of a word-end vocabulary as sorted arrays."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path) as file:
            held = json.load(file)
        model = held["model"]
        vocab, end = model["vocab"], model["end_of_word_suffix"] or ""
        self.width = np.int64(max(vocab.values()) + 1)
        letters = byte_letters()
        self.inner = np.array([vocab[x] for x in letters], np.int64)
        self.final = np.array([vocab[x + end] for x in letters], np.int64)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        keys = left * self.width + right
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.made = keys[order], order.astype(np.int32), made[order]
        #: True if what a merge makes only takes part in later merges: then equal pairs of a word may merge at once.
        born = np.full(int(self.width), -1)
        born[made[::-1]] = np.arange(len(made))[::-1]
        self.rising = bool((np.maximum(born[left], born[right]) < np.arange(len(made))).all())
        self.tokenizer = Tokenizer.from_file(path)
        self.special = {t["content"] for t in held["added_tokens"]}
        self.byte_of = {x: b for b, x in enumerate(letters)}

    def lookup(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = left * self.width + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], _NONE), at

    def count(self, words: list[bytes]) -> np.ndarray:
        """Number of symbols that each word ends up with."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        data = np.frombuffer(b"".join(words), np.uint8)
        out = np.minimum(sizes, 1)
        own = np.flatnonzero(sizes > 1)
        symbols = self.inner[data]
        symbols[np.cumsum(sizes)[sizes > 0] - 1] = self.final[data[np.cumsum(sizes)[sizes > 0] - 1]]
        symbols = symbols[np.repeat(sizes > 1, sizes)]
        sizes = sizes[own]
        while len(own):
            ends = np.cumsum(sizes)
            starts = ends - sizes
            rank, at = np.full(len(symbols), _NONE, np.int32), np.zeros(len(symbols), np.int64)
            rank[:-1], at[:-1] = self.lookup(symbols[:-1], symbols[1:])
            rank[ends - 1] = _NONE  # no pair reaches into the next word
            least = np.minimum.reduceat(rank, starts)
            going = least < _NONE
            if not going.all():
                out[own[~going]] = sizes[~going]
                keep = np.repeat(going, sizes)
                symbols, rank, at = symbols[keep], rank[keep], at[keep]
                own, sizes, least = own[going], sizes[going], least[going]
                if not len(own):
                    break
                ends = np.cumsum(sizes)
                starts = ends - sizes
            hit = np.flatnonzero(rank == np.repeat(least, sizes))
            word = np.searchsorted(ends, hit, "right")
            if self.rising:
                # in a row of overlapping equal pairs every second one merges, from the left
                head = np.ones(len(hit), bool)
                head[1:] = (hit[1:] != hit[:-1] + 1) | (word[1:] != word[:-1])
                place = np.arange(len(hit)) - np.maximum.accumulate(np.where(head, np.arange(len(hit)), 0))
                take = place % 2 == 0
            else:
                take = np.append(True, word[1:] != word[:-1])
            hit, word = hit[take], word[take]
            symbols[hit] = self.made[at[hit]]
            keep = np.ones(len(symbols), bool)
            keep[hit + 1] = False
            symbols = symbols[keep]
            sizes = sizes - np.bincount(word, minlength=len(sizes))
        return out

    def exact_pieces(self, text: str) -> list[bytes]:
        """Pieces of a text with any characters: the vocabulary's own normaliser and pattern, special strings whole."""
        out = []
        for part in self._parts(text):
            if part in self.special:
                out.append(b"")  # one token, whatever its bytes
                continue
            normal = self.tokenizer.normalizer.normalize_str(part)
            for piece, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(normal):
                out.append(bytes(self.byte_of[x] for x in piece))
        return out

    def _parts(self, text: str) -> Iterator[str]:
        import re

        if not self.special:
            yield text
            return
        longest = sorted(self.special, key=lambda s: (-len(s), s))
        for part in re.split("(" + "|".join(map(re.escape, longest)) + ")", text):
            if part:
                yield part


@lru_cache(maxsize=2)
def load_merges(path: str) -> Merges:
    return Merges(path)


def count_tokens(
    docs: DataFrame, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Number of tokens of every whole text: id_col, n_bytes (UTF-8) and n_tokens, both long.

    No begin or end token is added and nothing is cut. Null and empty texts have 0 of both. Repeated rows give
    repeated results; an empty table an empty one. vocabulary_path must be readable on the executors.
    """
    recent = Recent(1_000_000)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merges = load_merges(vocabulary_path)

        def make(words: list[bytes]) -> list[int]:
            special = [not w for w in words]
            return [1 if s else n for s, n in zip(special, merges.count(words).tolist(), strict=True)]

        for batch in batches:
            for first, end, data, bounds in slices(batch.column(1)):
                words, codes, pieces = distinct_pieces(data, bounds, bare_pieces, merges.exact_pieces, lower=True)
                tokens = np.array(recent.values(words, make), np.int64)
                total = sums_between(tokens[codes], np.concatenate([[0], np.cumsum(pieces)]))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, end - first), pa.array(np.diff(bounds)), pa.array(total)],
                    names=[id_col, "n_bytes", "n_tokens"],
                )

    schema = f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, n_bytes bigint, n_tokens bigint"
    return docs.select(id_col, text_col).mapInArrow(run, schema)
