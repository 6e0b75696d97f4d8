"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import carried, carried_fields, slices, sums_between, tidy, with_text_last

ORDERS = (1, 2, 3)
BITS = 15
SLICE = 1 << 20  # bytes of text at once; the arrays of a slice take some fifty times as much
UNKNOWN = "und"
_U = np.uint32


@lru_cache(maxsize=1)
def _letters() -> tuple[np.ndarray, np.ndarray]:
    """For code points of the first plane: the small letter, or a space for what is no letter; and is it a letter."""
    chars = [chr(c) for c in range(1 << 16)]
    alpha = np.array([c.isalpha() for c in chars])
    small = np.array([ord(c.lower()) if len(c.lower()) == 1 else ord(c) for c in chars], _U)
    return np.where(alpha, small, _U(0x20)).astype(_U), alpha


def _characters(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Folded code points of the texts, bounds of the texts in them, and which texts have a letter."""
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), _U)
    before = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    edges = before[bounds]
    fold, alpha = _letters()
    inside = np.minimum(points, 0xFFFF)
    folded, letter = fold[inside], alpha[inside]
    far = np.flatnonzero(points > 0xFFFF)
    if len(far):
        kinds, which = np.unique(points[far], return_inverse=True)
        is_letter = np.array([chr(c).isalpha() for c in kinds.tolist()])[which]
        letter = letter.copy()
        letter[far] = is_letter
        folded[far] = np.where(is_letter, points[far], _U(0x20))
    return folded, edges, sums_between(letter.astype(np.int64), edges) > 0


def _grams(folded: np.ndarray, edges: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each order the hash bucket of every n-gram inside a text, and the bounds of the texts in them."""
    for order in ORDERS:
        n = max(0, len(folded) - order + 1)
        total = np.full(n, 0x9E3779B1 * order & 0xFFFFFFFF, _U)
        for k in range(order):
            total *= _U(0x01000193)
            total ^= folded[k : k + n]
            total *= _U(0x85EBCA6B)
            total ^= total >> _U(15)
        total *= _U(0x9E3779B1)
        buckets = total >> _U(32 - BITS)
        counts = np.maximum(np.diff(edges) - order + 1, 0)
        if order > 1:  # an n-gram may not begin in one text and end in the next
            keep = np.ones(n, bool)
            for k in range(1, order):
                cut = edges[1:-1] - k
                cut = cut[(cut >= 0) & (cut < n)]
                keep[cut] = False
            buckets = buckets[keep]
        yield buckets, np.concatenate([[0], np.cumsum(counts)])


@dataclass
class Model:
    """Languages and the logarithm of each bucket's probability (buckets x languages) and of each language's share."""

    langs: list[str]
    table: np.ndarray
    prior: np.ndarray


def fit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", smoothing: float = 0.5) -> Model:
    """Counts every n-gram of every row with a text and a language. What reaches the driver is one count for each
    language and bucket, whatever the number of rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}  # the last place counts documents
        for batch in batches:
            for first, end, data, bounds in slices(batch.column(1), SLICE):
                folded, edges, _ = _characters(data, bounds)
                langs = batch.column(0).slice(first, end - first).to_pylist()
                names = sorted(set(langs))
                own = np.array([names.index(x) for x in langs])
                for name in names:
                    held.setdefault(name, np.zeros((1 << BITS) + 1, np.int64))
                    held[name][-1] += langs.count(name)
                for buckets, at in _grams(folded, edges):
                    owner = np.repeat(own, np.diff(at)) << BITS
                    counts = np.bincount(owner + buckets, minlength=len(names) << BITS).reshape(len(names), -1)
                    for name, row in zip(names, counts, strict=True):
                        held[name][:-1] += row
        for name, counts in held.items():
            hit = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(hit)), pa.array(hit), pa.array(counts[hit])], names=["lang", "bucket", "n"]
            )

    rows = docs.select(lang_col, text_col).filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    parts = rows.mapInArrow(tidy(run), "lang string, bucket bigint, n bigint")
    sums = parts.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(set(sums["lang"]))
    counts = np.zeros(((1 << BITS) + 1, len(langs)))
    column = sums["lang"].map({x: i for i, x in enumerate(langs)}).to_numpy(np.int64)
    counts[sums["bucket"].to_numpy(np.int64), column] = sums["n"].to_numpy(np.float64)
    grams, texts = counts[:-1] + smoothing, counts[-1]
    return Model(langs, np.log(grams / grams.sum(0)), np.log(texts / texts.sum()) if len(langs) else texts)


def predict(
    docs: DataFrame,
    model: Model,
    text_col: str = "text",
    carry: tuple[str, ...] = ("doc_id",),
    names: tuple[str, str] = ("lang_pred", "score"),
) -> DataFrame:
    """The columns in carry and, under the two names, language and score (its posterior, 0 to 1) of every whole text.

    `und` with score 0 for null texts, texts without a letter, and if the model knows no language. Ties go to
    the language that sorts first. The three orders see the same characters, so the logarithms are divided by
    their number. Repeated rows give repeated results; an empty table an empty one.
    """
    held = docs.sparkSession.sparkContext.broadcast((model.langs, model.table, model.prior))  # languages x buckets

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, table, prior = held.value
        columns = np.ascontiguousarray(table.T)
        for batch in batches:
            for first, end, data, bounds in slices(batch.column(len(carry)), SLICE):
                folded, edges, known = _characters(data, bounds)
                total = np.zeros((len(langs), end - first))
                for buckets, at in _grams(folded, edges):
                    # rows of a sparse matrix (texts x buckets) times the table, a language at a time
                    for i, column in enumerate(columns):
                        total[i] += sums_between(column[buckets], at)
                if langs:
                    total = total / len(ORDERS) + prior[:, None]
                    best = total.argmax(0)
                    score = 1 / np.exp(total - total.max(0)).sum(0)
                else:
                    best, score, known = np.zeros(end - first, int), np.zeros(end - first), known & False
                found = [langs[b] if k else UNKNOWN for b, k in zip(best.tolist(), known.tolist(), strict=True)]
                yield carried(batch, first, end, carry, dict(zip(names, [
                    pa.array(found, pa.string()), pa.array(np.where(known, score, 0.0))
                ], strict=True)))

    fields = carried_fields(docs, carry, dict(zip(names, ["string", "double"], strict=True)))
    return with_text_last(docs, carry, text_col).mapInArrow(tidy(run), fields)
