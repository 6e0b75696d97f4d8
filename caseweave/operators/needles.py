"""Many literal needles in many texts: one automaton for all needles, one walk for each text.

Offsets count characters (code points) from zero, end exclusive. Letter case is folded before the walk, in Spark, so
that lengths stay. Occurrences of one needle do not overlap each other (the leftmost counts first); those of different
needles may.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import spans

SLICE_BYTES = 4 << 20  # needles that are broadcast at once
BATCH_CHARS = 4 << 20  # text that is turned into Python strings at once
NEEDLE = "struct<value:string,low:string>"
KEPT = 64  # automata that a task holds


class Automaton:
    """Finds all of a set of folded needles in one walk."""

    def __init__(self, needles: Iterable[str]):
        import ahocorasick

        self.size = 0
        self._tree = ahocorasick.Automaton()
        for needle in needles:
            if needle and needle not in self._tree:
                self._tree.add_word(needle, (needle, len(needle)))
                self.size += 1
        if self.size:
            self._tree.make_automaton()

    def starts(self, text: str) -> dict[str, list[int]]:
        """Starts of each needle that occurs."""
        out: dict[str, list[int]] = {}
        if not self.size:
            return out
        for last, (needle, length) in self._tree.iter(text):
            start = last - length + 1
            known = out.setdefault(needle, [])
            if not known or start >= known[-1] + length:
                known.append(start)
        return out


class Automata:
    """Automata by key, the last used ones held."""

    def __init__(self) -> None:
        self._held: dict[object, Automaton] = {}

    def of(self, key: object, needles: Iterable[str]) -> Automaton:
        found = self._held.pop(key, None)
        if found is None:
            found = Automaton(needles)
            while len(self._held) >= KEPT:
                self._held.pop(next(iter(self._held)))
        self._held[key] = found
        return found


def _parts(batch: pa.RecordBatch, text: int) -> Iterator[pa.RecordBatch]:
    """Runs of rows of about BATCH_CHARS of text."""
    lengths = pc.fill_null(pc.utf8_length(batch.column(text)), 0).to_pylist()
    first, size = 0, 0
    for k, n in enumerate(lengths):
        if k > first and size + n > BATCH_CHARS:
            yield batch.slice(first, k - first)
            first, size = k, 0
        size += n
    if first < batch.num_rows:
        yield batch.slice(first)


def locate(rows: DataFrame, text_col: str, needles: Column, fixed: Column | None = None) -> DataFrame:
    """Rows with `starts` (for each of their needles where it occurs) and `fresh` in place of the text.

    text_col: the folded text; needles: an array of struct(value, low), low being the folded needle. Of needles with
    one value the first has all occurrences, the others none; nulls have none. `fixed`, an array of struct(start, text),
    names spans known already: `fresh` tells of each whether no needle of that very value was found there.
    The other columns stay. A row is one walk, linear in its text, its needles and what is found.
    """
    carry = [c for c in rows.columns if c != text_col]
    if clash := {"starts", "fresh"} & set(carry):
        raise ValueError(f"columns {sorted(clash)} have names of results")
    known = F.coalesce(fixed, spans.empty("struct<start:int,text:string>")) if fixed is not None else spans.empty("struct<start:int,text:string>")
    sent = rows.select(
        *(F.col(f"`{c}`") for c in carry), F.col(f"`{text_col}`").alias("__low"),
        F.coalesce(needles, spans.empty(NEEDLE)).alias("__needles"), known.alias("__fixed"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automata = Automata()
        for batch in batches:
            for part in _parts(batch, len(carry)):
                starts, fresh = [], []
                columns = (part.column(len(carry) + k).to_pylist() for k in range(3))
                for low, own, spans_known in zip(*columns, strict=True):
                    lows = tuple(n["low"] if n and n["low"] else "" for n in own)
                    found = automata.of(lows, lows).starts(low or "") if any(lows) else {}
                    at: dict[str, list[int]] = {}
                    starts.append([])
                    for needle, key in zip(own, lows, strict=True):
                        value = needle["value"] if needle else None
                        first = bool(key) and value not in at
                        starts[-1].append(found.get(key, []) if first else [])
                        if first:
                            at[value] = starts[-1][-1]
                    where = {v: set(at[v]) for v in {s["text"] for s in spans_known} if v in at}
                    fresh.append([s["start"] not in where.get(s["text"], ()) for s in spans_known])
                old = [part.column(k) for k in range(len(carry))]
                more = [pa.array(starts, pa.list_(pa.list_(pa.int32()))), pa.array(fresh, pa.list_(pa.bool_()))]
                yield pa.RecordBatch.from_arrays([*old, *more], names=[*carry, "starts", "fresh"])

    kinds = {c: rows.schema[c].dataType.simpleString() for c in carry}
    fields = ", ".join(f"`{c}` {k}" for c, k in (kinds | {"starts": "array<array<int>>", "fresh": "array<boolean>"}).items())
    return sent.mapInArrow(run, fields)


def locate_in_cases(docs: DataFrame, needles: DataFrame) -> DataFrame:
    """case_id, ref, needle, start and end of every occurrence of a case's needles in the case's documents.

    docs: case_id, ref, text. needles: case_id, needle. Needles that fold alike are one, under its folded form; null
    and empty ones find nothing. The automaton of a case is built once in a task, however many needles it
    holds. Needles are broadcast in slices of about SLICE_BYTES; each slice is one pass over the texts.
    """
    spark = docs.sparkSession
    wanted = needles.select("case_id", spans.folded(F.col("needle")).alias("low")).filter("low <> ''").distinct()
    total = wanted.agg(F.sum(F.octet_length("low") + F.octet_length("case_id"))).first()[0] or 0
    slices = max(1, -(-total // SLICE_BYTES))
    rows = docs.select("case_id", "ref", spans.folded(F.col("text")).alias("low"))
    fields = "case_id string, ref string, needle string, start int, end int"
    out = spark.createDataFrame([], fields)
    for k in range(slices):
        by_case: dict[str, list[str]] = {}
        own = wanted if slices == 1 else wanted.filter(F.pmod(F.xxhash64("case_id", "low"), F.lit(slices)) == k)
        table = own.toArrow()
        for case, low in zip(table.column(0).to_pylist(), table.column(1).to_pylist(), strict=True):
            by_case.setdefault(case, []).append(low)
        out = out.unionByName(_case_pass(rows, by_case, fields))
    return out


def _case_pass(rows: DataFrame, by_case: dict[str, list[str]], fields: str) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(by_case)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automata = Automata()
        names = ["case_id", "ref", "needle", "start", "end"]
        for batch in batches:
            for part in _parts(batch, 2):
                found: list[tuple] = []
                for case, ref, low in zip(*(part.column(k).to_pylist() for k in range(3)), strict=True):
                    if low and case in shared.value:
                        every = automata.of(case, shared.value[case]).starts(low)
                        found += [(case, ref, n, s, s + len(n)) for n, at in every.items() for s in at]
                columns = zip(*found, strict=True) if found else [()] * 5
                kinds = [pa.string()] * 3 + [pa.int32()] * 2
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)

    return rows.mapInArrow(run, fields)
