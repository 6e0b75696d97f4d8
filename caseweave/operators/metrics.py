"""Case figures: funnels, corpus scale, counters, log statistics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import stats, text as tx, vocab
from .latest import latest_per_key
from .ordered import exact_median


def _by_case(frames: list[DataFrame]) -> DataFrame:
    """Per-case figures side by side, absent ones as zero: a union and one small aggregate, no joins."""
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    names = [c for c in rows.columns if c != "case_id"]
    return rows.groupBy("case_id").agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in names])


def _count(df: DataFrame, name: str, cond: Column | None = None) -> DataFrame:
    return df.groupBy("case_id").agg((F.count(F.lit(1)) if cond is None else F.count_if(cond)).alias(name))


def live_funnel(
    ingested: DataFrame, primary: DataFrame, redaction: DataFrame, leak_log: DataFrame, qa_log: DataFrame
) -> DataFrame:
    """Six figures per case. The logs are counted by row, as recorded, and by latest decision."""
    excluded = F.col("decision") == "accept_exclude"
    decided = F.coalesce("decision", F.lit("")).isin("", "pending")
    leak_last = latest_per_key(leak_log.select("case_id", "ref", "seq", "decision"), ["case_id", "ref"])
    qa_last = latest_per_key(qa_log.select("case_id", "ref", "seq", "decision"), ["case_id", "ref"])
    out = _by_case(
        [
            _count(ingested, "ingested"),
            _count(primary, "in_scope", F.col("primary_verdict") == "biographical"),
            _count(redaction, "redacted", F.col("status") == "redacted"),
            _count(leak_log, "leak_excluded_rows", excluded),
            _count(leak_last, "leak_excluded", excluded),
            _count(qa_log, "qa_decided_rows", ~decided),
            _count(qa_last, "qa_decided", ~decided),
        ]
    )
    return out.withColumns(
        {
            "final_rows": F.greatest(F.lit(0), F.col("redacted") - F.col("leak_excluded_rows")),
            "final": F.greatest(F.lit(0), F.col("redacted") - F.col("leak_excluded")),
        }
    )


def closure_funnel(
    inputs: DataFrame, ingested: DataFrame, findings: DataFrame, primary: DataFrame, redaction: DataFrame, tags: DataFrame
) -> DataFrame:
    """Closure figures per case, restricted to canonical documents where the case has any.

    tags: case_id, ref, entity_count, redact_count, flag_count, subject_count.
    """
    canonical = findings.filter("dedupe_verdict = 'canonical'").select("case_id", "ref").distinct()
    mark = canonical.withColumn("is_canonical", F.lit(True))
    has = canonical.select("case_id").distinct().withColumn("has_canonical", F.lit(True))

    def restricted(df: DataFrame) -> DataFrame:
        rows = df.join(mark, ["case_id", "ref"], "left").join(has, "case_id", "left")
        return rows.filter(F.col("is_canonical") | F.col("has_canonical").isNull())

    verdicts = restricted(primary.select("case_id", "ref", "primary_verdict").distinct())
    outcome = restricted(redaction.select("case_id", "ref", "status"))
    entity = tags.groupBy("case_id").agg(
        F.sum("entity_count").alias("pii_entities_total"),
        F.sum("redact_count").alias("pii_redact_third_party"),
        F.sum("flag_count").alias("pii_flag_for_review"),
        F.sum("subject_count").alias("pii_subject_preserved"),
    )
    out = _by_case(
        [
            _count(ingested, "ingested"),
            _count(inputs, "attempted_rows"),
            _count(findings, "duplicates_removed", F.col("dedupe_verdict") == "duplicate"),
            _count(canonical, "n_canonical"),
            _count(verdicts, "biographical_canonical", F.col("primary_verdict") == "biographical"),
            _count(verdicts, "incidental_canonical", F.col("primary_verdict") == "work_context_only"),
            _count(outcome, "leak_failures_canonical", F.col("status") == "failed"),
            _count(outcome, "redacted_ok_canonical", F.col("status") == "redacted"),
            entity,
        ]
    )
    attempted = F.when(F.col("attempted_rows") > 0, F.col("attempted_rows")).otherwise(F.col("ingested"))
    return out.withColumns(
        {
            "source_attempted": attempted,
            "extraction_failed": F.greatest(attempted - F.col("ingested"), F.lit(0)),
            "unique_after_dedupe": F.when(F.col("n_canonical") > 0, F.col("n_canonical")).otherwise(F.col("ingested")),
            "final_disclosure_items": F.greatest(
                F.col("redacted_ok_canonical"), F.col("biographical_canonical") - F.col("leak_failures_canonical")
            ),
        }
    ).drop("attempted_rows", "n_canonical")


def corpus_scale(docs: DataFrame) -> DataFrame:
    """Documents and words per case."""
    return docs.groupBy("case_id").agg(
        F.count(F.lit(1)).alias("doc_count"), F.sum(tx.word_count(F.col("text"))).alias("word_count")
    )


def value_counts(rows: DataFrame, column: Column, keys: list[str] | None = None) -> DataFrame:
    """Counts per value, long form; absent values read as `unknown`."""
    keys = keys or ["case_id"]
    value = F.when(F.coalesce(column, F.lit("")) == "", "unknown").otherwise(column)
    return rows.groupBy(*keys, value.alias("value")).agg(F.count(F.lit(1)).alias("n"))


def as_map(counts: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Value counts of a closed vocabulary as one map per group (the manifest summary)."""
    keys = keys or ["case_id"]
    pairs = F.array_sort(F.collect_list(F.struct("value", "n")))
    return counts.groupBy(*keys).agg(F.map_from_entries(pairs).alias("summary"))


def decision_counts(rows: DataFrame, domain: list[str], keys: list[str] | None = None) -> DataFrame:
    """Rows per decision of a closed vocabulary, zero where there is none, and the total."""
    keys = keys or ["case_id"]
    return rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total"), *stats.zero_filled(domain, F.col("decision"))
    )


def stage_flow(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """(case, stage, value, count) over several stage tables, each with the column to count."""
    parts = [
        value_counts(df, F.col(column)).withColumn("stage", F.lit(stage)) for stage, (df, column) in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts).select("case_id", "stage", "value", "n")


def kept_share(primary: DataFrame) -> DataFrame:
    """Verdict shares per case: what the scope stage kept."""
    v = F.col("primary_verdict")
    bio, known = F.count_if(v == "biographical"), F.count_if(v.isin(*vocab.PRIMARY_VERDICTS))
    return primary.groupBy("case_id").agg(
        known.alias("evaluated"),
        bio.alias("biographical"),
        F.count_if(v == "work_context_only").alias("work_context_only"),
        F.count_if(v == "ambiguous").alias("ambiguous"),
        F.round(F.coalesce(F.try_divide(100.0 * bio, known), F.lit(0.0)), 4).alias("pct_kept"),
    )


def top_values(counts: DataFrame, n: int = 5, keys: list[str] | None = None) -> DataFrame:
    """The n most common values per group, ties by value."""
    order = Window.partitionBy(*(keys or ["case_id"])).orderBy(F.desc("n"), "value")
    return counts.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)


def stage_stats(log: DataFrame) -> DataFrame:
    """Per case and stage: runs, failures, first and last ordinal, duration of the last run, longest run."""
    ends = log.filter("event = 'stage_end'")
    return ends.groupBy("case_id", "stage").agg(
        F.count(F.lit(1)).alias("runs"),
        F.count_if(F.col("outcome") == "failed").alias("failed"),
        F.min("seq").alias("first_seq"),
        F.max("seq").alias("last_seq"),
        F.max_by("duration_s", "seq").alias("last_duration_s"),
        F.max("duration_s").alias("max_duration_s"),
    )


def halt_reasons(log: DataFrame) -> DataFrame:
    return log.filter("event = 'run_complete' and halted").select("case_id", "seq", "halt_reason")


def log_anomalies(
    log: DataFrame,
    dispute_counts: DataFrame,
    rerank: DataFrame,
    rows: DataFrame,
    threshold: float = 0.01,
    near: float = 0.02,
) -> DataFrame:
    """Deterministic findings about a run: one row per case and category, with severity and count.

    dispute_counts: case_id, disputed, classified. rerank: case_id, rerank_score. rows: case_id,
    schema_version, producer_version (any artefact rows).
    """
    ends = log.filter("event = 'stage_end'")
    median = exact_median(ends, ["stage"], "duration_s", F.floor("duration_s"), "median_s")
    slow = ends.join(median, "stage").filter(F.col("duration_s") > 5 * F.col("median_s"))
    runs = log.groupBy("case_id").agg(
        F.count_if(F.col("event") == "run_complete").alias("runs"),
        F.count_if((F.col("event") == "stage_end") & (F.col("outcome") == "failed")).alias("failed"),
        F.count_if((F.col("event") == "run_complete") & F.col("halted")).alias("halts"),
        F.count_if((F.col("event") == "stage_end") & (F.col("stage") == "export")).alias("exports"),
    )
    share = F.try_divide(F.col("disputed"), F.col("classified"))

    def finding(df: DataFrame, category: str, severity: Column | str, n: Column) -> DataFrame:
        level = F.lit(severity) if isinstance(severity, str) else severity
        return df.select("case_id", F.lit(category).alias("category"), level.alias("severity"), n.cast("bigint").alias("n"))

    grouped = lambda df, name: df.groupBy("case_id").agg(F.count(F.lit(1)).alias(name))
    no_version = rows.filter(F.coalesce("schema_version", F.lit("")).eqNullSafe("") | F.coalesce("producer_version", F.lit("")).eqNullSafe(""))
    edge = rerank.groupBy("case_id").agg(
        F.count_if(F.abs(F.col("rerank_score") - threshold) <= near).alias("close"), F.count(F.lit(1)).alias("all_")
    )
    parts = [
        finding(runs.filter("failed > 0"), "stage_failed", "critical", F.col("failed")),
        finding(runs.filter("halts > 0"), "pipeline_halted", "critical", F.col("halts")),
        finding(grouped(slow, "n"), "stage_duration_outlier", "warning", F.col("n")),
        finding(
            dispute_counts.filter(share > 0.05), "dispute_rate", F.when(share > 0.20, "critical").otherwise("warning"), F.col("disputed")
        ),
        finding(grouped(no_version, "n"), "schema_violation", "warning", F.col("n")),
        finding(runs.filter("runs > 3"), "rerun_pattern", "warning", F.col("runs")),
        finding(runs.filter("exports = 0 and halts = 0"), "completeness", "warning", F.col("runs")),
        finding(edge.filter("close * 2 > all_"), "threshold_edge", "info", F.col("close")),
    ]
    return reduce(DataFrame.unionByName, parts)


def severity_rollup(findings: DataFrame) -> DataFrame:
    """Findings per severity and whether the case is blocked."""
    s = F.col("severity")
    return findings.groupBy("case_id").agg(
        F.count_if(s == "info").alias("n_info"),
        F.count_if(s == "warning").alias("n_warning"),
        F.count_if(s == "critical").alias("n_critical"),
        F.bool_or(s == "critical").alias("blocked"),
    )


def truth_distribution(truth: DataFrame) -> DataFrame:
    return truth.groupBy("case_id", "truth_class", "category").agg(F.count(F.lit(1)).alias("n"))


def readiness(cases: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Release readiness per case from its stage and its latest release verdict."""
    last = verdicts.groupBy("case_id").agg(F.max_by("decision", "seq").alias("decision"))
    rows = cases.join(last, "case_id", "left")
    state = F.when(F.col("current_stage") == "closed", "case_closed").otherwise(
        stats.lookup(vocab.READINESS, F.coalesce("decision", F.lit("")), F.lit(vocab.READINESS_NONE))
    )
    return rows.select("case_id", "current_stage", "decision", state.alias("readiness"))
