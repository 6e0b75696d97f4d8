"""Review work: unextractable inputs, blockers, the scored action queue, phases, waivers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import stats, text as tx, times, vocab
from .latest import latest_per_key

STAGE_PHASE = {stage: i for i, (_, stages) in enumerate(vocab.PHASES) for stage in stages}
STAGE_INDEX = {s: i for i, s in enumerate(s for _, stages in vocab.PHASES for s in stages)}


def phase_of(stage: Column) -> Column:
    """Phase index of a stage; an unknown stage reads as the first phase."""
    return stats.lookup(STAGE_PHASE, F.coalesce(stage, F.lit("")), F.lit(0))


def unextractable(inputs: DataFrame, ingested: DataFrame, decisions: DataFrame) -> DataFrame:
    """Input files that were not ingested, with file name, suffix and latest decision."""
    last = latest_per_key(decisions, ["case_id", "path"]).select(
        "case_id", "path", "decision", "reason_code", F.col("ts").alias("decision_ts")
    )
    return (
        inputs.filter("path <> ''")
        .join(ingested.select("case_id", "path"), ["case_id", "path"], "left_anti")
        .join(last, ["case_id", "path"], "left")
        .select(
            "case_id",
            "path",
            tx.file_name(F.col("path")).alias("filename"),
            tx.extension(F.col("path")).alias("extension"),
            F.coalesce("decision", F.lit("pending")).alias("decision"),
            F.coalesce("reason_code", F.lit("")).alias("reason_code"),
            F.coalesce("decision_ts", F.lit("")).alias("decision_ts"),
        )
    )


def open_blockers(verdicts: DataFrame, resolved: DataFrame) -> DataFrame:
    """Blocking issues of each case's latest release verdict that nobody resolved.

    verdicts: case_id, seq, ts, blocking_issues array<struct<issue_id, issue, severity>>.
    """
    last = verdicts.groupBy("case_id").agg(F.max_by(F.struct("ts", "blocking_issues"), "seq").alias("v"))
    issues = last.select("case_id", F.col("v.ts").alias("ts"), F.explode("v.blocking_issues").alias("b"))
    rows = issues.select("case_id", "ts", "b.issue_id", "b.issue", "b.severity").filter(
        F.coalesce("issue_id", F.lit("")) != ""
    )
    return rows.join(resolved.select("case_id", "issue_id").distinct(), ["case_id", "issue_id"], "left_anti")


def blocker_summary(verdicts: DataFrame, resolved: DataFrame) -> DataFrame:
    """Total and open blockers per case, open ones by severity."""
    total = verdicts.groupBy("case_id").agg(F.size(F.max_by("blocking_issues", "seq")).alias("total"))
    left = open_blockers(verdicts, resolved).groupBy("case_id").agg(
        F.count(F.lit(1)).alias("open"),
        F.count_if(F.col("severity") == "CRITICAL").alias("open_critical"),
        F.count_if(F.col("severity") == "HIGH").alias("open_high"),
    )
    return total.join(left, "case_id", "left").na.fill(0)


def _undecided(rows: DataFrame, decisions: DataFrame, key: str) -> DataFrame:
    """Rows with no decision other than pending, ever."""
    done = decisions.filter(~F.coalesce("decision", F.lit("pending")).isin("pending")).select("case_id", key)
    return rows.join(done, ["case_id", key], "left_anti")


def queue_items(
    blockers: DataFrame,
    failed: DataFrame,
    leak_decisions: DataFrame,
    missing: DataFrame,
    missing_decisions: DataFrame,
    asof: Column,
) -> DataFrame:
    """Pending items from the three sources in one shape."""
    risk = stats.lookup(vocab.SEVERITY_RISK, F.upper(F.coalesce("severity", F.lit(""))), F.lit(vocab.SEVERITY_RISK_DEFAULT))
    a = blockers.select(
        "case_id",
        F.lit("blocker").alias("kind"),
        F.col("issue_id").alias("item_id"),
        F.coalesce("issue", "issue_id").alias("label"),
        risk.alias("risk"),
        F.lit("release_gate_running").alias("stage"),
        times.age_hours(times.parse_iso(F.col("ts")), asof).alias("age_hours"),
        F.lit(0).alias("source_ord"),
    )
    b = _undecided(failed.filter("status = 'failed' and ref <> ''"), leak_decisions, "ref").select(
        "case_id",
        F.lit("leak_review").alias("kind"),
        F.col("ref").alias("item_id"),
        F.coalesce("filename", "ref").alias("label"),
        F.lit(vocab.LEAK_RISK).alias("risk"),
        F.lit("redaction_running").alias("stage"),
        F.lit(0.0).alias("age_hours"),
        F.lit(1).alias("source_ord"),
    )
    c = _undecided(missing, missing_decisions, "path").select(
        "case_id",
        F.lit("unextractable").alias("kind"),
        F.col("path").alias("item_id"),
        tx.file_name(F.col("path")).alias("label"),
        F.lit(vocab.UNEXTRACTABLE_RISK).alias("risk"),
        F.lit("ingestion_qc_running").alias("stage"),
        F.lit(0.0).alias("age_hours"),
        F.lit(2).alias("source_ord"),
    )
    return a.unionByName(b).unionByName(c)


def scored_queue(items: DataFrame, cases: DataFrame, recent: DataFrame, asof: Column) -> DataFrame:
    """Items of phases the case has reached, with their five-factor score.

    items: case_id, kind, item_id, risk, stage. cases: case_id, current_stage, received (date or
    null). recent: case_id, recent (newest first). The caller orders by score where needed; a top
    list is `next_best`.
    """
    w, n = vocab.QUEUE_WEIGHTS, vocab.QUEUE_RECENT
    rows = items.join(cases, "case_id", "left").join(recent, "case_id", "left")
    rows = rows.withColumns(
        {
            "current_phase": phase_of(F.col("current_stage")),
            "stage_position": phase_of(F.col("stage")),
            "recent": F.slice(F.coalesce("recent", F.expr("cast(array() as array<string>)")), 1, n),
        }
    ).filter(F.col("stage_position") <= F.col("current_phase"))
    left = times.sla_days(F.col("received"), asof)
    urgency = F.coalesce(F.greatest(F.lit(0.0), F.least(F.lit(1.0), 1.0 - left / vocab.SLA_DAYS)), F.lit(0.5))
    early = F.when(F.col("current_phase") == 0, F.lit(1.0)).otherwise(
        F.greatest(F.lit(0.0), 1.0 - F.try_divide(F.col("stage_position"), F.col("current_phase")))
    )
    same = F.size(F.filter("recent", lambda k: k == F.col("kind"))) / n
    one_kind = (F.size("recent") > 0) & F.forall("recent", lambda k: k == F.element_at("recent", 1))
    fresh = F.when(one_kind & (F.try_element_at("recent", F.lit(1)) != F.col("kind")), 1.0).otherwise(0.0)
    rows = rows.withColumns(
        {
            "sla_days_remaining": left,
            "sla_factor": urgency,
            "stage_factor": early,
            "fatigue_penalty": same,
            "diversity_bonus": fresh,
        }
    )
    score = (
        w["risk"] * F.col("risk") / 10.0
        + w["sla"] * F.col("sla_factor")
        + w["stage"] * F.col("stage_factor")
        - w["fatigue"] * F.col("fatigue_penalty")
        + w["diversity"] * F.col("diversity_bonus")
    )
    return rows.withColumn("score", score).drop("recent", "current_stage", "received")


def next_best(queue: DataFrame, n: int = 1) -> DataFrame:
    """The n highest-scored items per case; equal scores keep source order, then item id."""
    order = Window.partitionBy("case_id").orderBy(F.desc("score"), "source_ord", "item_id")
    return queue.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)


def phase_status(cases: DataFrame) -> DataFrame:
    """done / current / pending for each of the four phases of a case."""
    spansof = [
        F.struct(
            F.lit(key).alias("phase"), F.lit(STAGE_INDEX[stages[0]]).alias("first"), F.lit(STAGE_INDEX[stages[-1]]).alias("last")
        )
        for key, stages in vocab.PHASES
    ]
    at = stats.lookup(STAGE_INDEX, F.coalesce("current_stage", F.lit("")))
    rows = cases.select("case_id", at.alias("at"), F.inline(F.array(*spansof)))
    status = (
        F.when(F.col("at").isNull() | (F.col("at") < F.col("first")), "pending")
        .when(F.col("at") > F.col("last"), "done")
        .otherwise("current")
    )
    return rows.select("case_id", "phase", status.alias("status"))


def waiver_states(log: DataFrame) -> DataFrame:
    """Current state of each waiver from its append-only log, counting transitions that were not allowed.

    A waiver is proposed once (first `pending` row) and co-signed once, after that. Both moments
    are minima, so no waiver's history is gathered.
    """
    keys = ["case_id", "waiver_id"]
    proposed = log.filter("state = 'pending'").groupBy(*keys).agg(
        F.min_by(F.struct("seq", "operator_id", "justification"), "seq").alias("p")
    )
    # the earliest co-signature after the proposal
    signed = (
        log.filter("state = 'co_signed'")
        .join(proposed.select(*keys, F.col("p.seq").alias("from_seq")), keys, "inner")
        .filter(F.col("seq") > F.col("from_seq"))
        .groupBy(*keys)
        .agg(F.min_by(F.struct("seq", "dpo_id"), "seq").alias("c"))
    )
    total = log.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
    out = total.join(proposed, keys, "left").join(signed, keys, "left")
    valid = F.col("p").isNotNull().cast("int") + F.col("c").isNotNull().cast("int")
    return out.select(
        *keys,
        F.when(F.col("c").isNotNull(), "co_signed").when(F.col("p").isNotNull(), "pending").otherwise("invalid").alias("state"),
        F.col("p.seq").alias("proposed_seq"),
        F.col("p.operator_id").alias("operator_id"),
        F.col("c.seq").alias("co_signed_seq"),
        F.col("c.dpo_id").alias("dpo_id"),
        (F.col("rows") - valid).alias("rejected_transitions"),
    )
