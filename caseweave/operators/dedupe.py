"""Exact duplicates: marking, filtering, summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def mark_duplicates(docs: DataFrame, message_id: Column | None = None) -> DataFrame:
    """One canonical document per message id, else per content hash: the smallest ref.

    `docs` needs case_id, ref, hash. The canonical set is found by a pre-combining
    minimum per key and joined back on the unique ref, so a key shared by a large part
    of the corpus is never gathered in one task. Text itself is not shuffled.
    """
    has_id = F.lit(False) if message_id is None else F.coalesce(message_id, F.lit("")) != ""
    # not-null keys: a null test on one side only would keep both sides from sharing one exchange
    keyed = docs.select(
        F.coalesce("case_id", F.lit("")).alias("case_id"),
        F.coalesce("ref", F.lit("")).alias("ref"),
        F.when(has_id, message_id if message_id is not None else F.lit("")).otherwise(F.col("hash")).alias("dedupe_key"),
        F.when(has_id, "message_id").otherwise("sha256").alias("dedupe_basis"),
    ).repartition("case_id", "ref")
    canonical = (
        keyed.groupBy("case_id", "dedupe_basis", "dedupe_key")
        .agg(F.min("ref").alias("ref"), F.count(F.lit(1)).alias("copies"))
        .select("case_id", "ref", "copies")
    )
    return keyed.join(canonical, ["case_id", "ref"], "left").select(
        "case_id",
        "ref",
        F.when(F.col("copies").isNull(), "duplicate").otherwise("canonical").alias("dedupe_verdict"),
        "dedupe_basis",
        "dedupe_key",
        F.coalesce("copies", F.lit(0)).alias("copies"),
    )


def _canonical_counts(findings: DataFrame) -> DataFrame:
    return findings.groupBy("case_id").agg(F.count_if(F.col("dedupe_verdict") == "canonical").alias("n_canonical"))


def keep_canonical(rows: DataFrame, findings: DataFrame, include_duplicates: bool = False) -> DataFrame:
    """Rows whose ref is canonical. Cases without findings, or with no canonical ref, keep everything."""
    if include_duplicates:
        return rows
    canonical = findings.filter(F.col("dedupe_verdict") == "canonical").select("case_id", "ref").distinct()
    usable = _canonical_counts(findings).filter("n_canonical > 0").select("case_id")
    kept = rows.join(canonical, ["case_id", "ref"], "left_semi")
    return kept.unionByName(rows.join(usable, "case_id", "left_anti"))


def filter_status(rows: DataFrame, findings: DataFrame, include_duplicates: bool = False) -> DataFrame:
    """What the canonical filter did in each case: mode and counts."""
    canonical = findings.filter(F.col("dedupe_verdict") == "canonical").select("case_id", "ref").distinct()
    matched = (
        rows.select("case_id", "ref")
        .join(canonical.withColumn("hit", F.lit(1)), ["case_id", "ref"], "left")
        .groupBy("case_id")
        .agg(F.count(F.lit(1)).alias("input_count"), F.count("hit").alias("n_hit"))
    )
    out = matched.join(_canonical_counts(findings), "case_id", "left")
    on = F.coalesce(F.col("n_canonical") > 0, F.lit(False)) & F.lit(not include_duplicates)
    mode = F.lit("include_duplicates") if include_duplicates else F.when(on, "canonical_only").otherwise("no_filter")
    skipped = F.when(on, F.col("input_count") - F.col("n_hit")).otherwise(0)
    return out.select(
        "case_id",
        mode.alias("mode"),
        "input_count",
        F.when(on, F.col("n_canonical")).otherwise(F.col("input_count")).alias("canonical_count"),
        skipped.alias("skipped"),
        F.when(F.col("n_canonical") == 0, "no canonical refs: filter not applied").otherwise("").alias("warning"),
        F.format_string(
            "%s: %d of %d refs to process", mode, F.col("input_count") - skipped, F.col("input_count")
        ).alias("summary"),
    )


def dedupe_summary(findings: DataFrame) -> DataFrame:
    """Canonical and duplicate counts per case, duplicates by basis, share collapsed."""
    dup = F.col("dedupe_verdict") == "duplicate"
    return findings.groupBy("case_id").agg(
        F.count_if(F.col("dedupe_verdict") == "canonical").alias("canonical"),
        F.count_if(dup).alias("duplicates"),
        F.count_if(dup & (F.col("dedupe_basis") == "message_id")).alias("duplicates_message_id"),
        F.count_if(dup & (F.col("dedupe_basis") == "sha256")).alias("duplicates_sha256"),
        F.round(100.0 * F.count_if(dup) / F.count(F.lit(1)), 4).alias("pct_collapsed"),
    )


def refs_by_hash(findings: DataFrame, register: DataFrame) -> DataFrame:
    """Findings keyed by content hash, translated to refs (the last ref of a hash, as registered).

    register: case_id, hash, ref and seq, the order of registration.
    """
    ref_of = register.filter("hash <> '' and ref <> ''").groupBy("case_id", "hash").agg(F.max_by("ref", "seq").alias("ref"))
    return findings.withColumnRenamed("doc_ref", "hash").join(ref_of, ["case_id", "hash"], "inner").drop("hash")
