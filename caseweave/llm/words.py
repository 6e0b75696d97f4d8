"""Words of many texts at once as 64-bit hashes, and shingles of five of them."""

from __future__ import annotations

import numpy as np

from .batches import take_ragged

_U = np.uint64
_STEP, _BACK = _U(0x9E3779B97F4A7C15), _U(pow(0x9E3779B97F4A7C15, -1, 2**64))
_WEIGHTS = np.array([pow(0xD1342543DE82EF95, k + 1, 2**64) for k in range(5)], _U)
SHINGLE = 5


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers whose output bits all depend on all input bits."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


#: A random-looking number for each byte; capital letters A to Z have those of small ones.
_BYTE = mixed(np.arange(1, 257, dtype=_U) * _STEP)
_BYTE[ord("A") : ord("Z") + 1] = _BYTE[ord("a") : ord("z") + 1]
BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True
_powers = [np.ones(1, _U), np.ones(1, _U)]


def _table(n: int) -> list[np.ndarray]:
    """Powers of an odd number and of its inverse, long enough for n bytes."""
    if len(_powers[0]) < n:
        for k, base in enumerate((_STEP, _BACK)):
            grown = np.full(n, base, _U)
            grown[0] = 1
            _powers[k] = np.cumprod(grown, dtype=_U)
    return _powers


class Words:
    """Words (runs without a blank byte, ASCII white space if not given) of texts data[bounds[i]:bounds[i + 1]]."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray, blank: np.ndarray = BLANK):
        blank = blank[data]
        edge = np.ones(len(data), bool)
        edge[1:] = blank[1:] != blank[:-1]
        edge[bounds[:-1][bounds[:-1] < len(data)]] = True
        runs = np.flatnonzero(edge)
        stops = np.append(runs[1:], len(data)) if len(runs) else runs
        word = ~blank[runs]
        self.starts, self.ends = runs[word], stops[word]
        self.bounds = np.searchsorted(self.starts, bounds)
        forth, back = _table(max(1, len(data)))
        self._sums = np.concatenate([np.zeros(1, _U), np.cumsum(_BYTE[data] * forth[: len(data)], dtype=_U)])
        self._back = back

    def hashes(self, most: int | None = None) -> np.ndarray:
        """Hash of each word in lower case A-Z, or of its first `most` bytes."""
        ends = self.ends if most is None else np.minimum(self.ends, self.starts + most)
        return mixed((self._sums[ends] - self._sums[self.starts]) * self._back[self.starts])

    def shingles(self) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all shingles and the bounds of each text in them.

        Five words in a row are a shingle; a text of one to four words is one shingle by itself, an empty
        text has none.
        """
        own = self.hashes()
        counts = np.diff(self.bounds)
        full = np.maximum(counts - SHINGLE + 1, 0)
        short = np.flatnonzero((counts > 0) & (full == 0))
        bounds = np.concatenate([[0], np.cumsum(full + ((counts > 0) & (full == 0)))])
        out = np.empty(int(bounds[-1]), _U)
        first = take_ragged(self.bounds[:-1], full)
        total = np.zeros(len(first), _U)
        for k in range(SHINGLE):
            total += own[first + k] * _WEIGHTS[k]
        out[take_ragged(bounds[:-1], full)] = mixed(total)
        if len(short):
            total = counts[short].astype(_U) * _STEP
            for k in range(SHINGLE - 1):
                has = counts[short] > k
                total[has] += own[self.bounds[short[has]] + k] * _WEIGHTS[k]
            out[bounds[short]] = mixed(total)
        return out, bounds
