"""Pre-token pieces of many texts at once, each distinct piece once.

Texts of plain Latin letters are split with numpy over their bytes. Any other text is split by the caller's
own exact function, so the fast way is only ever a shorter road to the same pieces.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd

OTHER, LETTER, DIGIT, SPACE, FOREIGN = range(5)

#: Class of each byte in a text of ASCII and U+00C0 to U+00FF; a text with a FOREIGN byte is not plain.
_KIND = np.full(256, FOREIGN, np.uint8)
_KIND[0x21:0x7F] = OTHER
_KIND[[0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20]] = SPACE
_KIND[[*range(ord("0"), ord("9") + 1)]] = DIGIT
_KIND[[*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1), 0xC3, *range(0x80, 0xC0)]] = LETTER
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[[*range(ord("A"), ord("Z") + 1), *range(0x80, 0x97), *range(0x98, 0x9F)]] += 0x20
_LEFT = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [2**64 - 1], np.uint64)
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)
_LANES = 32


def plain_rows(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Which texts hold only bytes that the fast way knows, and no start of a special token."""
    odd = _KIND[data] == FOREIGN
    if len(data) > 1:
        odd[:-1] |= (data[:-1] == ord("<")) & (data[1:] == ord("|"))
    fine = np.ones(len(bounds) - 1, bool)
    fine[np.searchsorted(bounds, np.flatnonzero(odd), "right") - 1] = False
    return fine


def _kinds(data: np.ndarray) -> np.ndarray:
    kinds = _KIND[data]
    signs = np.flatnonzero((data == 0x97) | (data == 0xB7))  # the multiplication and division signs are no letters
    signs = signs[data[signs - 1] == 0xC3] if len(signs) else signs
    kinds[signs] = kinds[signs - 1] = OTHER
    return kinds


def _runs(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and kinds of runs of one kind inside a text."""
    kinds = _kinds(data)
    cut = np.ones(len(data), bool)
    cut[1:] = kinds[1:] != kinds[:-1]
    cut[bounds[:-1][bounds[:-1] < len(data)]] = True
    starts = np.flatnonzero(cut)
    return starts, np.append(starts[1:], len(data)), kinds[starts]


def _short_forms(data, bounds, starts, ends, kinds) -> tuple[np.ndarray, np.ndarray]:
    """Runs that are a lone apostrophe before s, t, m, d, re, ve or ll, and the ends of these short forms."""
    lone = (data[starts] == ord("'")) & (ends - starts == 1)
    lone[-1:] = False
    lone[:-1] &= (kinds[1:] == LETTER) & ~np.isin(starts[1:], bounds)
    at = np.flatnonzero(lone)
    one = data[ends[at]]
    two = np.where(ends[at + 1] - ends[at] > 1, data[np.minimum(ends[at] + 1, len(data) - 1)], 0)
    pair = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
    single = np.isin(one, list(b"stmd"))
    found = single | pair
    return at[found], ends[at[found]] + np.where(single[found], 1, 2)


def spaced_pieces(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of pieces where one space joins the run behind it (pattern of byte-level vocabularies)."""
    if not len(data):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    starts, ends, kinds = _runs(data, bounds)
    space = kinds == SPACE
    followed = np.zeros(len(starts), bool)
    followed[:-1] = ~np.isin(starts[1:], bounds)
    last = ends - 1
    joins = space & followed & (data[last] == ord(" "))
    joined = np.zeros(len(starts), bool)
    joined[1:] = joins[:-1]
    at, stop = _short_forms(data, bounds, starts, ends, kinds)
    stop, at = stop[~joined[at]], at[~joined[at]]
    cut = np.zeros(len(data) + 1, bool)
    cut[starts[~joined]] = True
    cut[last[space & followed]] = True
    cut[ends[at]] = False  # the letters of a short form belong to its apostrophe
    cut[stop] = True
    cut[len(data)] = False
    cut[bounds[:-1][bounds[:-1] < len(data)]] = True
    begin = np.flatnonzero(cut)
    return begin, np.append(begin[1:], len(data))


def bare_pieces(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of pieces without white space, each digit by itself (pattern of word-end vocabularies)."""
    if not len(data):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    starts, ends, kinds = _runs(data, bounds)
    at, stop = _short_forms(data, bounds, starts, ends, kinds)
    cut = np.zeros(len(data) + 1, bool)
    cut[starts] = True
    cut[np.flatnonzero(_KIND[data] == DIGIT)] = True
    cut[ends[at]] = False
    cut[stop] = True
    cut[len(data)] = False
    cut[bounds[:-1][bounds[:-1] < len(data)]] = True
    begin = np.flatnonzero(cut)
    end = np.append(begin[1:], len(data))
    keep = _KIND[data[begin]] != SPACE
    return begin[keep], end[keep]


def _distinct(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[list[bytes], np.ndarray]:
    """The distinct byte strings data[start:end] and, for each of all, which one it is.

    Strings of up to 32 bytes are compared as four 64-bit lanes, longer ones as bytes.
    """
    lengths = ends - starts
    whole = data.tobytes()
    padded = np.frombuffer(whole + bytes(_LANES), np.uint8)
    words = np.ndarray((len(data) + _LANES - 7,), "<u8", padded, strides=(1,))
    lanes, key = [], lengths.astype(np.uint64)
    for k in range(_LANES // 8):
        lane = np.zeros(len(starts), np.uint64)
        use = np.flatnonzero(lengths > 8 * k)
        lane[use] = words[starts[use] + 8 * k] & _LEFT[np.minimum(lengths[use] - 8 * k, 8)]
        key = (key ^ lane) * _ODD[k]
        key ^= key >> np.uint64(29)
        lanes.append(lane)
    codes, distinct = pd.factorize(key)
    first = np.empty(len(distinct), np.int64)
    first[codes[::-1]] = np.arange(len(codes))[::-1]
    same = lengths <= _LANES
    same &= lengths == lengths[first][codes]
    for lane in lanes:
        same &= lane == lane[first][codes]
    found = [whole[s:e] for s, e in zip(starts[first].tolist(), ends[first].tolist(), strict=True)]
    rest = np.flatnonzero(~same)  # longer strings, and strings whose keys happen to be equal
    if len(rest):
        more = {}
        codes = codes.copy()
        for i in rest.tolist():
            word = whole[starts[i] : ends[i]]
            if found[codes[i]] == word:
                continue
            if word not in more:
                more[word] = len(found)
                found.append(word)
            codes[i] = more[word]
    return found, codes


def distinct_pieces(
    data: np.ndarray,
    bounds: np.ndarray,
    fast: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]],
    exact: Callable[[str], list[bytes]],
    lower: bool = False,
) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Distinct pieces, the index of each piece in order of the texts, and the number of pieces of each text.

    lower: plain texts are put in lower case before splitting; `exact` does so itself.
    """
    rows = len(bounds) - 1
    fine = plain_rows(data, bounds)
    sizes = np.diff(bounds)
    if fine.all():
        kept, inner = data, bounds
    else:
        kept = data[np.repeat(fine, sizes)]
        inner = np.concatenate([[0], np.cumsum(sizes[fine])])
    if lower:
        kept = _LOWER[kept]
    starts, ends = fast(kept, inner)
    words, codes = _distinct(kept, starts, ends)
    counts = np.zeros(rows, np.int64)
    counts[fine] = np.diff(np.searchsorted(starts, inner))
    if fine.all():
        return words, codes, counts
    own = {w: i for i, w in enumerate(words)}
    parts, at = [], 0
    for row in range(rows):
        if fine[row]:
            parts.append(codes[at : at + counts[row]])
            at += counts[row]
            continue
        found = exact(data[bounds[row] : bounds[row + 1]].tobytes().decode("utf-8"))
        counts[row] = len(found)
        parts.append(np.array([own.setdefault(w, len(own)) for w in found], np.int64))
    return list(own), np.concatenate(parts), counts


class Recent:
    """What was found for recent pieces. Bounded: the older half goes when it is full."""

    def __init__(self, most: int = 400_000):
        self.most, self.new, self.old = most // 2, {}, {}

    def values(self, words: list[bytes], make: Callable[[list[bytes]], list]) -> list:
        new, old = self.new, self.old
        out = [new.get(w) for w in words]
        missing = []
        for i, value in enumerate(out):
            if value is None:
                word = words[i]
                if (value := old.get(word)) is None:
                    missing.append(i)
                else:
                    out[i] = new[word] = value
        if missing:
            lacking = [words[i] for i in missing]
            for i, word, value in zip(missing, lacking, make(lacking), strict=True):
                out[i] = new[word] = value
        if len(new) > self.most:
            self.old, self.new = new, {}
        return out
