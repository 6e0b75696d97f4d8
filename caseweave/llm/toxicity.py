"""Toxicity by weak supervision.

Many lexicon voters (words) and pattern voters (beginnings of words) vote for toxic or abstain. A generative
label model estimates how often each fires on either class and which fire together; its posterior labels train
a linear classifier.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .batches import carried, carried_fields, slices, tidy, with_text_last
from .words import BLANK, Words, mixed

SLICE = 1 << 20  # bytes of text at once; the arrays of a slice take some fifty times as much
SAMPLE = 20_000  # labelled documents that the model is fitted on, at most
FEATURES = 4096  # voters kept, the strongest
VOTERS = 256  # of these the label model weighs, the strongest
STRENGTH = 20.0  # log-likelihood ratio that a word or pattern needs to become a voter
PREFIXES = (None, 4, 5, 6, 7)  # whole words, and their first bytes
_GOLD = 3.0  # log odds that a given label is right
_SEPARATORS = BLANK.copy()
_SEPARATORS[[*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = True


@dataclass
class Model:
    """Hashes of the voters, ascending, with the weight of each, and the bias."""

    keys: np.ndarray
    weights: np.ndarray
    bias: float


def _features(data: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Hash and text of each occurrence of a voter, one kind after the other."""
    words = Words(data, bounds, _SEPARATORS)
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(words.bounds))
    for kind, most in enumerate(PREFIXES):
        yield mixed(words.hashes(most) + np.uint64(kind)), owner


def _pairs(data: np.ndarray, bounds: np.ndarray, keep) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, voter) pairs; keep: hashes to positions of those wanted."""
    found, owners = [], []
    for hashes, owner in _features(data, bounds):
        at = keep(hashes)
        found.append(hashes[at])
        owners.append(owner[at])
    hashes, owner = np.concatenate(found), np.concatenate(owners)
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    new = np.append(True, (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1]))[: len(hashes)]
    return hashes[new], owner[new]


def _wanted(keys: np.ndarray):
    """Positions of hashes that are among keys (ascending): a small bitmap first, then exactly."""
    bitmap = np.zeros(1 << 20, bool)
    bitmap[keys >> np.uint64(44)] = True

    def keep(hashes: np.ndarray) -> np.ndarray:
        at = np.flatnonzero(bitmap[hashes >> np.uint64(44)])
        if not len(keys):
            return at[:0]
        place = np.minimum(np.searchsorted(keys, hashes[at]), len(keys) - 1)
        return at[keys[place] == hashes[at]]

    return keep


def _labelled(docs, labels, id_col, text_col, label_col, sample) -> DataFrame:
    """`toxic` and `text` of at most `sample` labelled documents, one of each set of equal texts."""
    given = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("toxic"))
    given = given.filter("id is not null and toxic is not null").groupBy("id").agg(F.max("toxic").alias("toxic"))
    given = given.orderBy(F.xxhash64("id"), "id").limit(sample)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).filter("text is not null")
    both = texts.join(F.broadcast(given), "id").withColumn("h", F.xxhash64("text"))  # `sample` rows of two numbers
    # an id may have any number of texts: what counts is bounded once more
    rows = both.groupBy("h", "id").agg(F.count(F.lit(1)).alias("n"))
    first = rows.groupBy("h").agg(F.min("id").alias("id"), F.min_by("n", "id").alias("n"))
    first = cut_lineage(first.orderBy(F.xxhash64("h"), "h").limit(sample))
    chosen = both.join(F.broadcast(first.select("id", "h")), ["id", "h"])
    if first.filter("n > 1").limit(1).count():  # a chosen row is repeated; else no text is shuffled
        chosen = chosen.dropDuplicates(["h"])
    return chosen.select("toxic", "text")


def _voters(rows: DataFrame, features: int) -> tuple[np.ndarray, int, int]:
    """Hashes of the words and beginnings of words that speak most for toxic."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            toxic = batch.column(0).to_numpy(zero_copy_only=False)
            for first, _, data, bounds in slices(batch.column(1), SLICE):
                hashes, owner = _pairs(data, bounds, lambda h: np.arange(len(h)))
                keys, which = np.unique(hashes, return_inverse=True)
                bad = np.bincount(which, toxic[first + owner] > 0, len(keys)).astype(np.int64)
                every = np.bincount(which, minlength=len(keys))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.view(np.int64)), pa.array(bad), pa.array(every)], names=["key", "bad", "every"]
                )

    sizes = rows.agg(F.sum((F.col("toxic") > 0).cast("long")).alias("bad"), F.count(F.lit(1)).alias("every")).first()
    bad, every = sizes["bad"] or 0, sizes["every"]
    if not 0 < bad < every:
        return np.empty(0, np.uint64), bad, every
    share = bad / every
    counts = rows.mapInArrow(tidy(run), "key bigint, bad bigint, every bigint").groupBy("key")
    counts = counts.agg(F.sum("bad").alias("bad"), F.sum("every").alias("every"))
    clean = F.col("every") - F.col("bad")
    strength = 2 * (
        F.col("bad") * F.log(F.col("bad") / (F.col("every") * share))
        + F.when(clean > 0, clean * F.log(clean / (F.col("every") * (1 - share)))).otherwise(0.0)
    )
    counts = counts.filter((F.col("bad") > 2) & (F.col("bad") > F.col("every") * share)).withColumn("g", strength)
    # with few labels the bar falls to what a handful of texts can show
    needed = min(STRENGTH, 0.25 * -2 * bad * float(np.log(share)))
    best = counts.filter(F.col("g") >= needed).orderBy(F.desc("g"), "key").limit(features).select("key")
    return best.toPandas()["key"].to_numpy(np.int64).view(np.uint64), bad, every


def _votes(rows: DataFrame, keys: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Given labels, and which voters (by place in keys) fire on each document."""
    held = rows.sparkSession.sparkContext.broadcast(keys)  # at most FEATURES numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep = _wanted(held.value)
        for batch in batches:
            for first, end, data, bounds in slices(batch.column(1), SLICE):
                hashes, owner = _pairs(data, bounds, keep)
                place = np.searchsorted(held.value, hashes).astype(np.int32)
                edges = np.searchsorted(owner, np.arange(end - first + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, end - first), pa.ListArray.from_arrays(pa.array(edges), pa.array(place))],
                    names=["toxic", "voters"],
                )

    found = rows.mapInArrow(tidy(run), "toxic int, voters array<int>").toPandas()
    order = sorted(range(len(found)), key=lambda i: (found["toxic"][i], tuple(found["voters"][i])))
    return found["toxic"].to_numpy()[order], [np.asarray(found["voters"][i], np.int64) for i in order]


def label_model(votes: np.ndarray, given: np.ndarray, rounds: int = 15) -> np.ndarray:
    """Posterior probability of toxic for each document (rows of votes: fired or abstained).

    Expectation maximisation over each voter's firing rates on the two classes. Voters that fire together
    beyond what the class explains share their say: each counts 1 / (1 + sum of its positive correlations).
    """
    prior = np.clip(given.mean(), 1e-3, 1 - 1e-3)
    posterior = np.where(given > 0, 0.95, 0.05 * prior)
    n, m = votes.shape
    for _ in range(rounds):
        on, off = posterior.sum(), n - posterior.sum()
        fires = (votes.T @ posterior + 0.5) / (on + 1)
        false = (votes.T @ (1 - posterior) + 0.5) / (off + 1)
        rest = votes - (posterior[:, None] * fires + (1 - posterior)[:, None] * false)
        spread = np.sqrt((rest**2).mean(0) + 1e-9)
        alike = np.clip(rest.T @ rest / n / spread / spread[:, None], 0, 1)
        say = 1 / (1 + alike.sum(0) - np.diag(alike)) if m else np.ones(0)
        yes, no = np.log(fires / false) * say, np.log((1 - fires) / (1 - false)) * say
        odds = np.log(prior / (1 - prior)) + votes @ (yes - no) + no.sum() + np.where(given > 0, _GOLD, -_GOLD)
        posterior = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
    return posterior


def linear_classifier(fired: list[np.ndarray], target: np.ndarray, features: int, rounds: int = 300) -> tuple[np.ndarray, float]:
    """Logistic regression on posterior labels with a ridge, by accelerated gradient steps."""
    sizes = np.array([len(x) for x in fired])
    column = np.concatenate(fired) if len(fired) else np.empty(0, np.int64)
    row = np.repeat(np.arange(len(fired)), sizes)
    scale = np.sqrt(np.bincount(column, minlength=features) / max(1, len(fired)) + 1e-4)
    weights, bias = np.zeros(features), float(np.log((target.mean() + 1e-3) / (1 - target.mean() + 1e-3)))
    speed, bias_speed = np.zeros(features), 0.0
    rate, ridge = 1.0, 1e-4
    for _ in range(rounds):
        odds = np.bincount(row, (weights / scale)[column], minlength=len(fired)) + bias
        wrong = 1 / (1 + np.exp(-np.clip(odds, -30, 30))) - target
        slope = np.bincount(column, wrong[row], minlength=features) / scale / len(fired) + ridge * weights
        norm = max(1.0, sizes.mean() * 2 + 1)
        speed = 0.9 * speed - rate / norm * slope
        bias_speed = 0.9 * bias_speed - rate / norm * wrong.mean()
        weights, bias = weights + speed, bias + bias_speed
    return weights / scale, bias


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    sample: int = SAMPLE,
    features: int = FEATURES,
) -> Model:
    """Learns from at most `sample` labelled documents, chosen by a hash of the id.

    Several labels of one id: toxic if one of them says so. Null ids, texts and labels teach nothing. Without
    both classes the model is the share of toxic among the labels (0 without labels).
    """
    rows = _labelled(docs, labels, id_col, text_col, label_col, sample)
    ranked, bad, every = _voters(rows, features)
    if not len(ranked):
        share = np.clip(bad / every if every else 0.0, 1e-6, 1 - 1e-6)
        return Model(ranked, np.empty(0), float(np.log(share / (1 - share))))
    keys = np.sort(ranked)
    given, fired = _votes(rows, keys)
    strongest = np.searchsorted(keys, ranked[:VOTERS])
    place = np.full(len(keys), -1)
    place[strongest] = np.arange(len(strongest))
    votes = np.zeros((len(fired), len(strongest)), np.float32)
    for i, own in enumerate(fired):
        own = place[own]
        votes[i, own[own >= 0]] = 1
    weights, bias = linear_classifier(fired, label_model(votes, given), len(keys))
    return Model(keys, weights, bias)


def score(
    docs: DataFrame, model: Model, text_col: str = "text", carry: tuple[str, ...] = ("doc_id",), name: str = "score"
) -> DataFrame:
    """The columns in carry and, under the name, the score (0 to 1) of every whole text; null counts as empty.

    Repeated rows give repeated results; an empty table an empty one; other columns are not read.
    """
    held = docs.sparkSession.sparkContext.broadcast((model.keys, model.weights, model.bias))  # at most FEATURES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, weights, bias = held.value
        keep = _wanted(keys)
        for batch in batches:
            for first, end, data, bounds in slices(batch.column(len(carry)), SLICE):
                hashes, owner = _pairs(data, bounds, keep)
                odds = np.full(end - first, bias)
                if len(hashes):
                    odds += np.bincount(owner, weights[np.searchsorted(keys, hashes)], minlength=end - first)
                scores = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
                yield carried(batch, first, end, carry, {name: pa.array(scores)})

    return with_text_last(docs, carry, text_col).mapInArrow(tidy(run), carried_fields(docs, carry, {name: "double"}))
