"""Hooks for models supplied by the caller. Each runs in Arrow batches inside tasks.

A scorer is created once per task by `make()`, so a model is loaded once and reused. It gets its texts in
runs of rows of about SLICE_BYTES, whatever the size of Arrow's batch, as strings of a whole batch take several times its
bytes. Arrow's batches are bounded by BATCH_BYTES where the session names no bound of its own. Filters do not pass through Python stages: reduce the input first (canonical set, resume set, cheap gate).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MakeEmbed = Callable[[], Callable[[list[str]], list[list[float]]]]
MakeRank = Callable[[], Callable[[list[str], list[str]], list[float]]]
MakeChat = Callable[[], Callable[[list[str]], list[str | None]]]
MakeFind = Callable[[], Callable[[list[str]], list[list[dict]]]]

SLICE_BYTES = 1 << 20
BATCH_BYTES = "4m"  # Spark's own bound is 64 MB, which each Python worker would hold


def _slices(batch: pa.RecordBatch, most: int) -> Iterator[pa.RecordBatch]:
    """Runs of rows of at most that many bytes of text, or of one row: texts are never cut."""
    sizes = np.zeros(batch.num_rows, np.int64)
    for column in batch.columns:
        sizes += pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    ends = np.concatenate([[0], np.cumsum(sizes)])
    row = 0
    while row < batch.num_rows:
        end = max(row + 1, int(np.searchsorted(ends, ends[row] + most, "right")) - 1)
        yield batch.slice(row, end - row)
        row = end


def _in_slices(rows: DataFrame, run: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]], schema: str, kinds: list) -> DataFrame:
    """`run` over the rows, strings all of them, in slices; its frames have the columns of the schema, of these Arrow types."""
    conf, bound = rows.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    if conf.get(bound, None) is None:
        conf.set(bound, BATCH_BYTES)
    names, most = [c.split(" ")[0] for c in schema.split(", ")], SLICE_BYTES
    fields = pa.schema(list(zip(names, kinds)))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for out in run(piece.to_pandas() for batch in batches for piece in _slices(batch, most)):
            yield pa.RecordBatch.from_pandas(out[names], fields, preserve_index=False)

    return rows.select(*(F.col(c).cast("string").alias(c) for c in rows.columns)).mapInArrow(task, schema)


def embed(docs: DataFrame, make: MakeEmbed) -> DataFrame:
    """case_id, ref, embedding for every text; a missing or empty vector stops the job."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fn = make()
        for b in batches:
            vectors = fn(b["text"].tolist())
            if len(vectors) != len(b):
                raise ValueError(f"embedder gave {len(vectors)} vectors for {len(b)} texts")
            if any(v is None or len(v) == 0 for v in vectors):
                raise ValueError("embedder gave an empty vector")
            yield pd.DataFrame({"case_id": b["case_id"], "ref": b["ref"], "embedding": vectors})

    kinds = [pa.string(), pa.string(), pa.list_(pa.float32())]
    return _in_slices(docs.select("case_id", "ref", "text"), run, "case_id string, ref string, embedding array<float>", kinds)


def rerank_scores(pairs: DataFrame, make: MakeRank) -> DataFrame:
    """case_id, ref, rerank_score for (case_id, ref, scope_text, text) rows."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fn = make()
        for b in batches:
            scores = fn(b["scope_text"].tolist(), b["text"].tolist())
            if len(scores) != len(b):
                raise ValueError(f"reranker gave {len(scores)} scores for {len(b)} rows")
            yield pd.DataFrame({"case_id": b["case_id"], "ref": b["ref"], "rerank_score": scores})

    kinds = [pa.string(), pa.string(), pa.float64()]
    rows = pairs.select("case_id", "ref", "scope_text", "text")
    return _in_slices(rows, run, "case_id string, ref string, rerank_score double", kinds)


def chat(prompts: DataFrame, make: MakeChat) -> DataFrame:
    """case_id, ref, reply, reachable for (case_id, ref, prompt) rows; no reply means unreachable."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fn = make()
        for b in batches:
            replies = fn(b["prompt"].tolist())
            yield pd.DataFrame(
                {
                    "case_id": b["case_id"],
                    "ref": b["ref"],
                    "reply": replies,
                    "reachable": [r is not None for r in replies],
                }
            )

    kinds = [pa.string(), pa.string(), pa.string(), pa.bool_()]
    rows = prompts.select("case_id", "ref", "prompt")
    return _in_slices(rows, run, "case_id string, ref string, reply string, reachable boolean", kinds)


def findings(docs: DataFrame, make: MakeFind) -> DataFrame:
    """Detector findings, one row each, for (case_id, ref, text) rows."""
    schema = "case_id string, ref string, stage int, surface string, type string, detector string, confidence double"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fn = make()
        for b in batches:
            rows = [
                (case, ref, f.get("stage"), f.get("surface"), f.get("type"), f.get("detector"), f.get("confidence"))
                for case, ref, found in zip(b["case_id"], b["ref"], fn(b["text"].tolist()))
                for f in found
            ]
            yield pd.DataFrame(
                rows, columns=["case_id", "ref", "stage", "surface", "type", "detector", "confidence"]
            )

    kinds = [pa.string(), pa.string(), pa.int32(), pa.string(), pa.string(), pa.string(), pa.float64()]
    return _in_slices(docs.select("case_id", "ref", "text"), run, schema, kinds)


def run_checks(tables: dict[str, DataFrame], rules: list[Callable[[dict[str, DataFrame]], DataFrame]]) -> DataFrame:
    """Caller-supplied verification rules, each DataFrames -> DataFrame, in one result."""
    from functools import reduce

    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [rule(tables) for rule in rules])
