"""Digests over sets, staleness and resume, the audit chain, corpus seals."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import hashing, vocab
from ..session import cut_lineage
from .ordered import linked


def listing_hash(df: DataFrame, keys: list[str], label: str, digest: str) -> DataFrame:
    """Digest over the one sorted listing of (label, digest) pairs of a group, as the reference writes it.

    The listing is never held: sorted rows stream through the digest, so a group of any size fits in memory. One
    SHA-256 is one chain, so a group is still read by one task; set_hash has no such bound.
    """
    line = F.concat(F.col("label"), F.lit(hashing.UNIT), F.col("digest"), F.lit(hashing.RECORD))
    rows = df.select(*keys, F.col(label).cast("string").alias("label"), F.col(digest).alias("digest"))
    rows = rows.repartition(*keys).sortWithinPartitions(*keys, "label", "digest")
    names = [*keys, "n_members", "set_hash"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, count, chain = None, 0, None

        def told() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([*key, pa.array([count]), pa.array([chain.hexdigest()])], names=names)

        for batch in batches:
            if not batch.num_rows:
                continue
            lines = pc.fill_null(batch.column(len(keys)), "").cast(pa.large_binary())
            offsets = np.frombuffer(lines.buffers()[1], np.int64)[lines.offset : lines.offset + len(lines) + 1]
            data = memoryview(lines.buffers()[2] or b"")
            codes = [batch.column(k).dictionary_encode("encode").indices.to_numpy(False) for k in range(len(keys))]
            heads = np.flatnonzero(np.any([c[1:] != c[:-1] for c in codes], axis=0)) + 1
            for lo, hi in zip([0, *heads.tolist()], [*heads.tolist(), batch.num_rows], strict=True):
                own = [batch.column(k).slice(lo, 1) for k in range(len(keys))]
                if chain is None or [x[0].as_py() for x in own] != [x[0].as_py() for x in key]:
                    if chain is not None:
                        yield told()
                    key, count, chain = own, 0, hashlib.sha256()
                count += hi - lo
                chain.update(data[offsets[lo] : offsets[hi]])
        if chain is not None:
            yield told()

    kinds = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys)
    return rows.select(*keys, line.alias("line")).mapInArrow(run, f"{kinds}, n_members bigint, set_hash string")


def set_hash(df: DataFrame, keys: list[str], label: str, digest: str) -> DataFrame:
    """Order-independent digest of (label, digest) pairs per group: a hash tree of one fixed form.

    Leaves are the listings of pairs whose label's own digest begins with the same six hex characters; three
    characters name their parents, and the root lists those. The form never depends on the size of a group, and
    no task lists more than one leaf or 4,096 children.
    """
    label_of = F.col(label).cast("string")
    nodes = df.select(
        *keys, F.substring(F.sha2(label_of, 256), 1, 6).alias("path"), label_of.alias("label"), F.col(digest).alias("digest"),
        F.lit(1).cast("bigint").alias("n"),
    )
    for length in (6, 3, 0):
        nodes = nodes.groupBy(*keys, F.substring("path", 1, length).alias("up")).agg(
            hashing.pairs_digest(F.collect_list(F.struct("label", "digest"))).alias("digest"), F.sum("n").alias("n")
        )
        nodes = nodes.withColumn("label", F.col("up")).withColumnRenamed("up", "path")
    return nodes.select(*keys, F.col("n").alias("n_members"), F.col("digest").alias("set_hash"))


def upstream_check(manifests: DataFrame, current: DataFrame) -> DataFrame:
    """Freshness of each stage's artefact: recorded against current upstream digest.

    manifests: case_id, stage, present, n_rows, recorded_hash. current: case_id, stage, upstream_hash.
    """
    rows = current.join(manifests, ["case_id", "stage"], "left")
    reason = (
        F.when(~F.coalesce("present", F.lit(False)), "artefact missing")
        .when(F.coalesce("upstream_hash", F.lit("")) == "", "upstream empty")
        .when(F.coalesce("n_rows", F.lit(0)) == 0, "artefact empty")
        .when(F.col("recorded_hash").isNull(), "no upstream_hash field")
        .when(F.col("recorded_hash") != F.col("upstream_hash"), "hash mismatch")
        .otherwise("artefact present + hash matches")
    )
    return rows.select("case_id", "stage", reason.alias("reason")).withColumn(
        "is_fresh", F.col("reason") == "artefact present + hash matches"
    )


def resume_plan(freshness: DataFrame, cases: DataFrame, unregistered_stale: bool = True) -> DataFrame:
    """Which coarse stages run again: the first stale one forces all after it.

    A case has as many rows here as there are stages, so the running maximum is small. Sub-stages
    without a freshness row follow `unregistered_stale`.
    """
    order = [
        F.struct(F.lit(i).alias("stage_idx"), F.lit(coarse).alias("coarse"), F.lit(sub).alias("stage"))
        for i, (coarse, subs) in enumerate(vocab.STAGE_ORDER)
        for sub in subs
    ]
    every = cases.select("case_id").distinct().select("case_id", F.inline(F.array(*order)))
    rows = every.join(freshness.select("case_id", "stage", "is_fresh"), ["case_id", "stage"], "left")
    stale = ~F.coalesce("is_fresh", F.lit(not unregistered_stale))
    coarse = rows.groupBy("case_id", "stage_idx", "coarse").agg(F.bool_or(stale).alias("stale"))
    upto = Window.partitionBy("case_id").orderBy("stage_idx").rowsBetween(Window.unboundedPreceding, 0)
    return coarse.withColumn("will_run", F.max("stale").over(upto))


# ---- audit chain -----------------------------------------------------------


def record_hash(seq: str = "seq") -> Column:
    """Hash of an event's record: its place and its body."""
    return hashing.json_digest(body=F.col("body"), seq=F.col(seq).cast("bigint"))


def emit_chain(events: DataFrame, seq: str = "seq", width: int = 100_000) -> DataFrame:
    """Events with event_hash, the hash of their record, and prev_hash, that of the event before them.

    One rule for all events of a case but the first, whose prev_hash is null. The predecessor comes from a
    bucketed lag, so a case of any size is chained in parallel. events: case_id, seq, body and any others.
    """
    rows = linked(events.withColumn("event_hash", record_hash(seq)), ["case_id"], seq, ["event_hash"], width)
    return rows.withColumnRenamed("prev_event_hash", "prev_hash")


def chain_heads(chain: DataFrame) -> DataFrame:
    """Per case the number of events and one digest over all of them: the root of a tree over their hashes."""
    return set_hash(chain, ["case_id"], "seq", "event_hash").select(
        "case_id", F.col("n_members").alias("events"), F.col("set_hash").alias("head")
    )


def verify_chain(events: DataFrame, seq: str = "seq", width: int = 100_000) -> DataFrame:
    """Each event with its status: genesis, ok, altered, broken or missing_predecessor.

    Every record is hashed anew. `altered`: the record is not the one its own event_hash was made of. `broken`:
    prev_hash is not the stored hash of the event that now stands before it (one is missing or was put in). So
    a changed body shows where it is, and a dropped event at the one behind it.
    """
    rows = linked(events, ["case_id"], seq, ["event_hash"], width)
    first = F.col("prev_event_hash").isNull()
    status = (
        F.when(~F.col("event_hash").eqNullSafe(record_hash(seq)), "altered")
        .when(first & F.col("prev_hash").isNull(), "genesis")
        .when(first, "missing_predecessor")
        .when(F.col("prev_hash").eqNullSafe(F.col("prev_event_hash")), "ok")
        .otherwise("broken")
    )
    return rows.withColumn("status", status)


def chain_summary(verified: DataFrame) -> DataFrame:
    """Per case: events, breaks, first break, intact or not."""
    bad = F.col("status").isin("altered", "broken", "missing_predecessor")
    return verified.groupBy("case_id").agg(
        F.count(F.lit(1)).alias("events"),
        F.count_if(bad).alias("breaks"),
        F.min(F.when(bad, F.col("seq"))).alias("first_break"),
        F.bool_and(~bad).alias("intact"),
    )


def seq_gaps(events: DataFrame, seq: str = "seq", width: int = 100_000) -> DataFrame:
    """Holes in a source's ordinals: one row per gap with what was expected and found."""
    rows = linked(events.withColumn("_s", F.col(seq)), ["case_id"], seq, ["_s"], width, "prev")
    gap = F.col(seq) - F.col("prev_s")
    return rows.filter(gap > 1).select(
        "case_id", (F.col("prev_s") + 1).alias("expected_seq"), F.col(seq).alias("found_seq"), (gap - 1).alias("missing")
    )


def uncompensated(chain: DataFrame, log: DataFrame) -> DataFrame:
    """Decisions in the chain but absent from the log, and the reverse, leaving out compensated ones.

    chain: case_id, event_hash, event_type, original_event_hash. log: case_id, event_hash.
    """
    key = ["case_id", "event_hash"]
    decided = chain.filter("event_type = 'reviewer_decision_made'").select(*key)
    repaired = chain.filter("event_type = 'failure_recorded'").select(
        "case_id", F.col("original_event_hash").alias("event_hash")
    )
    orphan = decided.join(log.select(*key), key, "left_anti").join(repaired, key, "left_anti")
    unchained = log.select(*key).join(decided, key, "left_anti")
    return orphan.withColumn("side", F.lit("chain_only")).unionByName(unchained.withColumn("side", F.lit("log_only")))


# ---- seals and cache keys --------------------------------------------------


def corpus_seal(files: DataFrame, truth: DataFrame) -> DataFrame:
    """Seal of a labelled corpus: each distinct text with line ends normalised, and its label.

    files: case_id, ref, text. truth: case_id, ref, label. A document without a label makes the
    seal null and is counted.
    """
    body = hashing.digest(hashing.normal_newlines(F.col("text")))
    # written once: the digests are narrow, and read three times below
    rows = cut_lineage(
        files.select("case_id", "ref", body.alias("content"))
        .distinct()
        .join(truth.select("case_id", "ref", "label"), ["case_id", "ref"], "left")
    )
    fault = rows.groupBy("case_id").agg(F.count_if(F.coalesce("label", F.lit("")) == "").alias("unlabelled"))
    line = hashing.json_digest(content=F.col("content"), label=F.coalesce("label", F.lit("")))
    sealed = set_hash(rows.withColumn("line", line), ["case_id"], "ref", "line")
    return sealed.join(fault, "case_id", "inner").select(
        "case_id", "n_members", "unlabelled", F.when(F.col("unlabelled") == 0, F.col("set_hash")).alias("seal")
    )


def cache_keys(artefacts: DataFrame) -> DataFrame:
    """Summary cache key per case and stage from each artefact's name, rows and sample digest.

    artefacts: case_id, stage, name, line_count, sample_sha. A stage has a handful of artefacts.
    """
    parts = F.transform(
        F.array_sort(F.collect_list(F.struct("name", F.col("line_count").cast("string").alias("lines"), "sample_sha"))),
        lambda a: F.concat_ws("|", a["name"], a["lines"], a["sample_sha"]),
    )
    joined = F.concat_ws("|", F.col("stage"), F.array_join(F.col("parts"), "|"))
    rows = artefacts.groupBy("case_id", "stage").agg(parts.alias("parts"))
    return rows.select("case_id", "stage", F.substring(hashing.digest(joined), 1, 16).alias("cache_key"))


def cache_hits(keys: DataFrame, cached: DataFrame) -> DataFrame:
    """Whether a stage's stored summary is still valid."""
    last = cached.groupBy("case_id", "stage").agg(F.max_by("cache_key", "seq").alias("stored"))
    return keys.join(last, ["case_id", "stage"], "left").withColumn(
        "hit", F.col("stored").eqNullSafe(F.col("cache_key"))
    )
