"""Texts of Arrow batches as byte arrays, in slices of bounded size, so that numpy works on many texts at once."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SLICE_BYTES = 4 << 20


def give_back() -> None:
    """Returns to the system what this Python worker holds free, as Spark keeps workers for later stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # not every C library has it
    if trim:
        trim(0)


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """The Arrow function, which gives its free memory back when it has seen all batches of its task."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return wrapped


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all rows and the n + 1 offsets that bound the rows; null counts as empty."""
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    column = pc.fill_null(column, "").cast(pa.large_string())
    _, where, data = column.buffers()
    offsets = np.frombuffer(where, np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8), offsets


def slices(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets from 0) for runs of rows of about `most` bytes.

    A longer text is a slice of its own: texts are never cut.
    """
    data, offsets = text_bytes(column)
    row, rows = 0, len(offsets) - 1
    while row < rows:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + most, "right")) - 1)
        yield row, end, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def take_ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices start, start + 1, ... of each run of the given length, run after run."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(total)


def sums_between(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of values[bounds[i]:bounds[i + 1]] for each i, 0 where that is empty."""
    out = np.zeros(len(bounds) - 1, np.float64 if values.dtype.kind == "f" else np.int64)
    full = bounds[1:] > bounds[:-1]
    if full.any():
        out[full] = np.add.reduceat(values, bounds[:-1][full], dtype=out.dtype)
    return out


def with_text_last(docs: DataFrame, carry: tuple[str, ...], text_col: str) -> DataFrame:
    """The columns to carry and behind them the text, under a name of its own."""
    return docs.select(*(F.col(f"`{c}`") for c in carry), F.col(f"`{text_col}`").alias("__text"))


def carried_fields(docs: DataFrame, carry: tuple[str, ...], more: dict[str, str]) -> str:
    """Schema of the carried columns and further ones."""
    kinds = {c: docs.schema[c].dataType.simpleString() for c in carry} | more
    return ", ".join(f"`{name}` {kind}" for name, kind in kinds.items())


def carried(batch: pa.RecordBatch, first: int, end: int, carry: tuple[str, ...], more: dict[str, pa.Array]) -> pa.RecordBatch:
    """Rows first to end of the carried columns, with further columns for the same rows."""
    old = [batch.column(k).slice(first, end - first) for k in range(len(carry))]
    return pa.RecordBatch.from_arrays([*old, *more.values()], names=[*carry, *more])
