"""Keyed state on the feed: sequence gaps, and alerts when a source falls silent."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
GAPS = "case_id string, source string, range bigint, expected_seq bigint, found_seq bigint, missing bigint, sign int"
RANGE = 100_000  # ordinals whose holes are one state
SILENCE = "case_id string, source string, kind string, silent_ms bigint"


class _Gaps(StatefulProcessor):
    """Remembers the holes in a range of ordinals of a (case, source) and reports how they open, shrink and close.

    It also reports the range's first and last ordinal whenever they change (sign 0): what lies between two ranges
    follows from these.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.ends = handle.getValueState("ends", "first bigint, last bigint")
        self.holes = handle.getMapState("holes", "expected_seq bigint", "found_seq bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        ends = known = self.ends.get() if self.ends.exists() else None
        before = {k[0]: v[0] for k, v in self.holes.iterator()} if ends else {}
        held = np.array(sorted(before.items()), dtype=np.int64).reshape(-1, 2)
        for part in rows:
            # a null ordinal says nothing about holes
            seqs = np.unique(part["seq"].dropna().to_numpy(dtype="int64"))
            if len(seqs):
                ends = ends or (int(seqs[0]), int(seqs[0]))
                closed, opened = changed_holes(held, ends, seqs)
                kept = held[~np.isin(held[:, 0], closed[:, 0])]
                held = np.concatenate([kept, opened])
                held = held[np.argsort(held[:, 0])]
                ends = min(ends[0], int(seqs[0])), max(ends[1], int(seqs[-1]))
                yield self._changes(key, closed, opened)
        after = dict(held.tolist())
        for expected in before.keys() - after.keys():
            self.holes.removeKey((expected,))
        for expected, found in after.items():
            if before.get(expected) != found:
                self.holes.updateValue((expected,), (found,))
        if ends and ends != known:
            self.ends.update(ends)
            none = np.empty((0, 2), np.int64)
            yield self._changes(key, none, none, np.array([ends], np.int64))

    @staticmethod
    def _changes(key, closed: np.ndarray, opened: np.ndarray, ends: np.ndarray = np.empty((0, 2), np.int64)) -> pd.DataFrame:
        both = np.concatenate([closed, opened, ends])
        return pd.DataFrame(
            {
                "case_id": np.full(len(both), key[0], dtype=object),
                "source": np.full(len(both), key[1], dtype=object),
                "range": np.full(len(both), key[2], dtype=np.int64),
                "expected_seq": both[:, 0],
                "found_seq": both[:, 1],
                "missing": both[:, 1] - both[:, 0],
                "sign": np.repeat(np.array([-1, 1, 0], np.int32), [len(closed), len(opened), len(ends)]),
            }
        )

    def close(self) -> None:
        pass


def changed_holes(held: np.ndarray, ends: tuple[int, int], seqs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The holes that arriving ordinals close, and those that they open.

    A hole is (expected, found): expected and what follows are missing, found is there. `held` are those known, in
    order, `ends` the smallest and largest ordinal known, `seqs` the new ones, ascending and distinct. An ordinal
    inside a hole closes it and opens what remains on its two sides.
    """
    first, last = ends
    points = np.concatenate([seqs[seqs < first], [first]]), np.concatenate([[last], seqs[seqs > last]])
    opened = [_between(p) for p in points]
    if not len(held):
        return held, np.concatenate(opened)

    def hole_of(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.maximum(np.searchsorted(held[:, 0], x, "right") - 1, 0)
        return at, (x >= held[at, 0]) & (x < held[at, 1])

    at, inside = hole_of(seqs)
    touched = np.zeros(len(held), bool)
    touched[at[inside]] = True
    closed = held[touched]
    pieces = _between(np.sort(np.concatenate([closed[:, 0] - 1, seqs[inside], closed[:, 1]])))
    at, within = hole_of(pieces[:, 0])  # what lies between two holes is there
    return closed, np.concatenate([*opened, pieces[within & touched[at]]])


def _between(points: np.ndarray) -> np.ndarray:
    """The holes between ascending ordinals."""
    at = np.flatnonzero(np.diff(points) > 1)
    return np.column_stack([points[at] + 1, points[at + 1]])


class _Silence(StatefulProcessor):
    """Sets a timer on every input; when it fires the source has been silent."""

    def __init__(self, limit_ms: int) -> None:
        self.limit_ms = limit_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.due = handle.getValueState("due", "at bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        for _ in rows:
            pass
        if self.due.exists():
            self.handle.deleteTimer(self.due.get()[0])
        at = timerValues.getCurrentProcessingTimeInMs() + self.limit_ms
        self.due.update((at,))
        self.handle.registerTimer(at)
        yield pd.DataFrame([], columns=["case_id", "source", "kind", "silent_ms"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.due.clear()
        yield pd.DataFrame(
            [(key[0], key[1], "silent", self.limit_ms)], columns=["case_id", "source", "kind", "silent_ms"]
        )

    def close(self) -> None:
        pass


def use_rocksdb(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)


def gap_stream(events: DataFrame, width: int = RANGE) -> DataFrame:
    """Changes of the sequence gaps per (case, source) of a stream with a `seq` column.

    sign 1 opens a gap, sign -1 takes one back that an ordinal of a later batch has filled or split; sign 0 tells the
    first and last ordinal of a range. `open_gaps` gives the balance. Each range of `width` ordinals is a state of its
    own, touched only by batches with ordinals in it: a key of any size is spread over tasks, and a task holds
    the holes of the ranges that its rows fall in. Null ordinals say nothing.
    """
    rows = events.filter("seq is not null").withColumn("range", F.floor(F.col("seq") / F.lit(width)).cast("bigint"))
    return rows.groupBy("case_id", "source", "range").transformWithStateInPandas(
        statefulProcessor=_Gaps(), outputStructType=GAPS, outputMode="append", timeMode="None"
    )


def open_gaps(changes: DataFrame) -> DataFrame:
    """The gaps that are open after all changes written by `gap_stream`, whatever batches the ordinals came in.

    A gap across the borders of ranges lies between the last ordinal of one and the first of the next that has any;
    of these there is one row a range.
    """
    gap = ["case_id", "source", "expected_seq", "found_seq", "missing"]
    inside = changes.filter("sign <> 0").groupBy(*gap).agg(F.sum("sign").alias("balance")).filter("balance > 0").select(*gap)
    ends = changes.filter("sign = 0").groupBy("case_id", "source", "range").agg(
        F.min("expected_seq").alias("first"), F.max("found_seq").alias("last")
    )
    in_order = Window.partitionBy("case_id", "source").orderBy("range")
    between = ends.withColumn("before", F.lag("last").over(in_order)).filter("first - before > 1")
    return inside.unionByName(between.select(
        "case_id", "source", (F.col("before") + 1).alias("expected_seq"), F.col("first").alias("found_seq"),
        (F.col("first") - F.col("before") - 1).alias("missing"),
    ))


def silence_stream(events: DataFrame, limit_ms: int = 15_000) -> DataFrame:
    """One alert per (case, source) whenever nothing arrived for `limit_ms`."""
    return events.groupBy("case_id", "source").transformWithStateInPandas(
        statefulProcessor=_Silence(limit_ms), outputStructType=SILENCE, outputMode="append", timeMode="ProcessingTime"
    )
