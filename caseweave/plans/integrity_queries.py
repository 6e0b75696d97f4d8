"""Funnels, log statistics, validation, digests, chains, unions, the feed."""

from __future__ import annotations

import os

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import hashing, stats, vocab
from ..operators import integrity, metrics, quality
from ..session import cut_lineage, run_folder
from ..streaming import feed, projection, watch
from . import standins as st
from .registry import query
from .standins import with_

# ---- figures ---------------------------------------------------------------


def _doc_log(spark, d):
    """The decision log under the case of the document it names."""
    docs = st.docs(spark, d).select("case_id", "ref")
    rows = st.decisions(spark, d).drop("case_id").join(docs, "ref")
    leak = F.when(F.col("decision") == "approve", "accept_exclude").otherwise(F.col("decision"))
    return rows, rows.withColumn("decision", leak)


FUNNEL = with_("register", "verdicts", "decisions") + (
    ", q as (select r.case_id, d.ref, seq, decision from decisions d join register r using (ref)), "
    "l as (select case_id, ref, arg_max(decision, seq) as decision from q group by 1, 2) "
)


@query(
    "live_funnel",
    FUNNEL
    + """select *, greatest(0, redacted - leak_excluded_rows) as final_rows, greatest(0, redacted - leak_excluded) as "final" from (
    select case_id, ingested, coalesce(in_scope, 0) as in_scope, redacted, coalesce(ler, 0) as leak_excluded_rows, coalesce(le, 0) as leak_excluded, coalesce(qr, 0) as qa_decided_rows, coalesce(q, 0) as qa_decided from
    (select case_id, count(*) as ingested, count(*) filter (where status = 'redacted') as redacted from register group by 1) a
    left join (select case_id, count(*) filter (where primary_verdict = 'biographical') as in_scope from verdicts group by 1) b using (case_id)
    left join (select case_id, count(*) filter (where decision = 'approve') as ler, count(*) filter (where decision <> 'pending') as qr from q group by 1) c using (case_id)
    left join (select case_id, count(*) filter (where decision = 'approve') as le, count(*) filter (where decision <> 'pending') as q from l group by 1) e using (case_id))""",
)
def live_funnel(spark, d):
    qa, leak = _doc_log(spark, d)
    reg = st.register(spark, d).drop("text")
    return metrics.live_funnel(reg, st.verdicts(spark, d), reg, leak, qa)


@query(
    "closure_funnel",
    with_("register", "verdicts")
    + """, f as (select case_id, ref, n_chars, ref = min(ref) over (partition by case_id, hash) as canon, status from register),
    v as (select v.case_id, primary_verdict from verdicts v join f using (case_id, ref) where canon),
    t as (select case_id, cast(sum(len(regexp_extract_all(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,}'))) as bigint) as n from register group by 1),
    a as (select case_id, count(*) as source_attempted, count(*) filter (where n_chars >= 100) as ingested, count(*) filter (where not canon) as duplicates_removed, count(*) filter (where canon) as unique_after_dedupe,
    count(*) filter (where canon and status = 'failed') as leak_failures_canonical, count(*) filter (where canon and status = 'redacted') as redacted_ok_canonical from f group by 1),
    b as (select case_id, count(*) filter (where primary_verdict = 'biographical') as bio, count(*) filter (where primary_verdict = 'work_context_only') as wco from v group by 1)
    select case_id, source_attempted, ingested, source_attempted - ingested as extraction_failed, duplicates_removed, unique_after_dedupe, bio as biographical_canonical, wco as incidental_canonical, leak_failures_canonical,
    redacted_ok_canonical, greatest(redacted_ok_canonical, bio - leak_failures_canonical) as final_disclosure_items, n as pii_entities_total, n as pii_redact_third_party, cast(0 as bigint) as pii_flag_for_review, cast(0 as bigint) as pii_subject_preserved
    from a join b using (case_id) join t using (case_id)""",
)
def closure_funnel(spark, d):
    from ..functions import spans
    from ..operators import dedupe

    reg = st.register(spark, d)
    n = F.size(spans.pattern_spans(F.col("text"), vocab.EMAIL, "email", F.contains("text", F.lit("@"))))
    zero = F.lit(0).cast("bigint")
    tags = reg.select("case_id", "ref", n.alias("entity_count"), n.alias("redact_count"), zero.alias("flag_count"), zero.alias("subject_count"))
    findings = cut_lineage(dedupe.mark_duplicates(reg.select("case_id", "ref", "hash")))
    return metrics.closure_funnel(reg, reg.filter("n_chars >= 100"), findings, st.verdicts(spark, d), reg, tags)


@query(
    "value_counts",
    with_("register") + "select case_id, ext as value, count(*) as n from register group by 1, 2",
)
def value_counts(spark, d):
    from ..functions import text as tx

    return metrics.value_counts(st.register(spark, d), F.ltrim(tx.extension(F.col("path")), F.lit(".")))


@query(
    "verdict_summary_map",
    with_("synth") + "select case_id, string_agg(scope_verdict || '=' || n, ',' order by scope_verdict) as summary from (select case_id, scope_verdict, count(*) as n from synth group by 1, 2) group by 1",
)
def verdict_summary_map(spark, d):
    from .scope_queries import synthesised

    m = metrics.as_map(metrics.value_counts(synthesised(spark, d), F.col("scope_verdict")))
    pairs = F.transform(F.array_sort(F.map_entries("summary")), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")))
    return m.select("case_id", F.array_join(pairs, ",").alias("summary"))


@query(
    "stage_flow",
    with_("register", "verdicts", "rechecks", "dispositions")
    + """select case_id, 'scope_check_running' as stage, primary_verdict as value, count(*) as n from verdicts group by 1, 3 union all
    select case_id, 'redaction_running', status, count(*) from register group by 1, 3 union all select case_id, 'responsiveness_running', disposition, count(*) from dispositions group by 1, 3 union all
    select case_id, 'redaction_qc_b_running', coalesce(recheck_verdict, 'unknown'), count(*) from rechecks group by 1, 3""",
)
def stage_flow(spark, d):
    return metrics.stage_flow(
        {
            "scope_check_running": (st.verdicts(spark, d), "primary_verdict"),
            "redaction_running": (st.register(spark, d), "status"),
            "responsiveness_running": (st.dispositions(spark, d), "disposition"),
            "redaction_qc_b_running": (st.rechecks(spark, d), "recheck_verdict"),
        }
    )


@query(
    "kept_share",
    with_("verdicts")
    + """select case_id, count(*) as evaluated, count(*) filter (where primary_verdict = 'biographical') as biographical, count(*) filter (where primary_verdict = 'work_context_only') as work_context_only,
    count(*) filter (where primary_verdict = 'ambiguous') as ambiguous, round(100.0::double * count(*) filter (where primary_verdict = 'biographical') / count(*), 4) as pct_kept from verdicts group by 1""",
)
def kept_share(spark, d):
    return metrics.kept_share(st.verdicts(spark, d))


@query(
    "top_changes",
    with_("plog")
    + """, c as (select case_id, stage || '/' || outcome || '/' || event as value, count(*) as n from plog group by 1, 2)
    select case_id, value, n, rank from (select *, row_number() over (partition by case_id order by n desc, value) as rank from c) where rank <= 5""",
)
def top_changes(spark, d):
    log = st.pipeline_log(spark, d)
    return metrics.top_values(metrics.value_counts(log, F.concat_ws("/", "stage", "outcome", "event")))


@query(
    "truth_distribution",
    "select lang as case_id, case when toxic = 1 then 'decoy' when quality = 1 then 'gold' else 'off_topic' end as truth_class, source as category, count(*) as n from labels join documents using (doc_id) group by 1, 2, 3",
)
def truth_distribution(spark, d):
    lab = st.table(spark, d, "labels").join(st.table(spark, d, "documents").select("doc_id", "lang", "source"), "doc_id")
    cls = F.when(F.col("toxic") == 1, "decoy").when(F.col("quality") == 1, "gold").otherwise("off_topic")
    return metrics.truth_distribution(lab.select(F.col("lang").alias("case_id"), cls.alias("truth_class"), F.col("source").alias("category")))


@query(
    "stage_stats",
    with_("plog")
    + """select case_id, stage, count(*) as runs, count(*) filter (where outcome = 'failed') as failed, min(seq) as first_seq, max(seq) as last_seq, arg_max(duration_s, seq) as last_duration_s, max(duration_s) as max_duration_s
    from plog where event = 'stage_end' group by 1, 2""",
)
def stage_stats(spark, d):
    return metrics.stage_stats(st.pipeline_log(spark, d))


@query("halt_reasons", with_("plog") + "select case_id, seq, halt_reason from plog where event = 'run_complete' and halted")
def halt_reasons(spark, d):
    return metrics.halt_reasons(st.pipeline_log(spark, d))


@query(
    "stage_medians",
    with_("plog") + "select stage, round(median(duration_s), 6) as median_s from plog where event = 'stage_end' group by 1",
)
def stage_medians(spark, d):
    from ..operators.ordered import exact_median

    ends = st.pipeline_log(spark, d).filter("event = 'stage_end'")
    return exact_median(ends, ["stage"], "duration_s", F.floor("duration_s"), "median_s").withColumn("median_s", F.round("median_s", 6))


ANOMALY = with_("plog") + (
    ", e as (select *, median(duration_s) over (partition by stage) as med from plog where event = 'stage_end'), "
    "g as (select case_id, count(*) filter (where event = 'run_complete') as runs, count(*) filter (where event = 'stage_end' and outcome = 'failed') as failed, "
    "count(*) filter (where event = 'run_complete' and halted) as halts, count(*) filter (where event = 'stage_end' and stage = 'export') as exports, "
    "count(*) filter (where event = 'stage_end' and stage = 'view') as disputed, count(*) as classified, count(*) filter (where abs(duration_s - 20) <= 15) as near, count(*) filter (where outcome = 'failed' and duration_s > 50) as nov from plog group by 1), "
    "f as (select case_id, 'stage_failed' as category, 'critical' as severity, failed as n from g where failed > 0 union all select case_id, 'pipeline_halted', 'critical', halts from g where halts > 0 "
    "union all select case_id, 'stage_duration_outlier', 'warning', count(*) from e where duration_s > 5 * med group by 1 "
    "union all select case_id, 'dispute_rate', case when disputed / classified::double > 0.2 then 'critical' else 'warning' end, disputed from g where disputed / classified::double > 0.05 "
    "union all select case_id, 'schema_violation', 'warning', nov from g where nov > 0 union all select case_id, 'rerun_pattern', 'warning', runs from g where runs > 3 "
    "union all select case_id, 'completeness', 'warning', runs from g where exports = 0 and halts = 0 union all select case_id, 'threshold_edge', 'info', near from g where near * 2 > classified) "
)


def _anomalies(spark, d):
    log = st.pipeline_log(spark, d)
    disputes = log.groupBy("case_id").agg(
        F.count_if((F.col("event") == "stage_end") & (F.col("stage") == "view")).alias("disputed"), F.count(F.lit(1)).alias("classified")
    )
    scores = log.select("case_id", F.col("duration_s").alias("rerank_score"))
    lost = (F.col("outcome") == "failed") & (F.col("duration_s") > 50)
    rows = log.select("case_id", F.lit("1.0").alias("schema_version"), F.when(~lost, "v").alias("producer_version"))
    return metrics.log_anomalies(log, disputes, scores, rows, 20.0, 15.0)


@query("log_anomalies", ANOMALY + "select * from f")
def log_anomalies(spark, d):
    return _anomalies(spark, d)


@query(
    "severity_rollup",
    ANOMALY
    + "select case_id, count(*) filter (where severity = 'info') as n_info, count(*) filter (where severity = 'warning') as n_warning, count(*) filter (where severity = 'critical') as n_critical, bool_or(severity = 'critical') as blocked from f group by 1",
)
def severity_rollup(spark, d):
    return metrics.severity_rollup(_anomalies(spark, d))


# ---- validation ------------------------------------------------------------


@query(
    "extraction_gate",
    with_("register")
    + """select case_id, refs_total, ocr_failures, round(rate, 6) as rate, case when rate > 0.5 then 'catastrophic' when rate > 0.1 then 'warning' else 'ok' end as gate from (
    select case_id, count(*) as refs_total, count(*) filter (where text_quality = 'ocr_failure') as ocr_failures, count(*) filter (where text_quality = 'ocr_failure') / count(*)::double as rate from register group by 1)""",
)
def extraction_gate(spark, d):
    return quality.extraction_gate(st.register(spark, d)).withColumn("rate", F.round("rate", 6))


@query(
    "required_fields",
    with_("register")
    + """select case_id, count(*) as n_rows, count(*) filter (where ref is null) as missing_ref, count(*) filter (where notes is null) as missing_notes, count(*) filter (where mailbox_owner_email is null) as missing_mailbox_owner_email,
    bool_and(ref is not null and notes is not null and mailbox_owner_email is not null) as ok from register group by 1""",
)
def required_fields(spark, d):
    return quality.required_fields(st.register(spark, d), ["ref", "notes", "mailbox_owner_email"])


@query(
    "first_findings",
    with_("register")
    + "select case_id, ref, rn from (select *, row_number() over (partition by case_id order by ref) as rn from register where mailbox_owner_email is null) where rn <= 5",
)
def first_findings(spark, d):
    return quality.first_findings(st.register(spark, d), F.col("mailbox_owner_email").isNull())


@query(
    "artefact_checks",
    with_("register", "verdicts", "synth", "dispositions")
    + """select case_id, 'register_ref' as "check", count(*) as n_rows, cast(0 as bigint) as n_bad, 'info' as severity from register group by 1
    union all select case_id, 'register_text', count(*), count(*) filter (where n_chars < 200), case when count(*) filter (where n_chars < 200) > 0 then 'critical' else 'info' end from register group by 1
    union all select case_id, 'verifier_high', count(*), count(*) filter (where n_chars > 20000), case when count(*) filter (where n_chars > 20000) > 0 then 'critical' else 'info' end from register group by 1
    union all select case_id, 'rerank_fields', count(*), count(*) filter (where doc_id % 97 = 5), case when count(*) filter (where doc_id % 97 = 5) > 0 then 'critical' else 'info' end from register group by 1
    union all select case_id, 'rerank_mode', count(*), count(*) filter (where lang = 'fr' or case_id < 'src2'), case when count(*) filter (where lang = 'fr' or case_id < 'src2') = count(*) then 'warning' else 'info' end from register group by 1
    union all select case_id, 'classify_fields', count(*), 0, 'info' from register group by 1
    union all select case_id, 'classify_verdict', count(*), count(*) filter (where lang = 'de'), case when count(*) filter (where lang = 'de') > 0 then 'critical' else 'info' end from register group by 1""",
)
def artefact_checks(spark, d):
    reg = st.register(spark, d)
    lang = F.col("lang")
    ranked = reg.select(
        "case_id", "ref", F.lit(0.5).alias("rerank_score"), F.lit(False).alias("would_drop"),
        F.when((lang == "fr") | (F.col("case_id") < "src2"), "enforce").otherwise("shadow").alias("mode"),
        F.when(F.col("doc_id") % 97 != 5, "h").alias("upstream_hash"),
    )
    classified = reg.select("case_id", "ref", F.array("ref").alias("entities"), F.when(lang == "de", "maybe").otherwise("confirmed").alias("in_scope_recheck"))
    return (
        quality.check_register(reg, reg.filter("n_chars >= 200"))
        .unionByName(quality.check_verifier(reg.select("case_id", F.when(F.col("n_chars") > 20000, "high").otherwise("low").alias("severity"))))
        .unionByName(quality.check_rerank(ranked, "shadow"))
        .unionByName(quality.check_classified(classified))
    )


@query(
    "incomplete_refs",
    with_("register", "verdicts") + "select case_id, ref from register where ref not in (select ref from verdicts)",
)
def incomplete_refs(spark, d):
    return quality.incomplete(st.register(spark, d), st.verdicts(spark, d))


@query(
    "upstream_consistency",
    with_("register")
    + """select case_id, artefact, count(distinct h) as distinct_hashes, count(*) as n_rows, case when count(distinct h) > 1 then 'warning' else 'info' end as severity from (
    select case_id, ext as artefact, case when n_chars > 10000 then 'h2' else 'h1' end as h from register) group by 1, 2""",
)
def upstream_consistency(spark, d):
    rows = st.register(spark, d).withColumn("upstream_hash", F.when(F.col("n_chars") > 10000, "h2").otherwise("h1"))
    return quality.upstream_consistency(rows, F.regexp_extract("filename", r"\.(\w+)$", 1))


@query(
    "reason_code_audit",
    with_("decisions")
    + """select case_id, error, is_valid, count(*) as n from (select case_id, error, error is null as is_valid from (select case_id, case when reason_code = 'R999' then 'unknown_code' when reason_code in ('R006', 'R010', 'R-PENDING') and trim(note) = '' then 'note_required' end as error from decisions)) group by 1, 2, 3""",
)
def reason_code_audit(spark, d):
    rows = quality.reason_code_audit(st.decisions(spark, d))
    return rows.groupBy("case_id", "error", "is_valid").agg(F.count(F.lit(1)).alias("n"))


@query(
    "stale_pending",
    with_("decisions")
    + f"select case_id, ref, seq, epoch(timestamp '{st.ASOF}') - epoch(cast(replace(replace(ts, 'T', ' '), 'Z', '') as timestamp)) > 86400 as is_stale from decisions where reason_code = 'R-PENDING'",
)
def stale_pending(spark, d):
    return quality.stale_pending(st.decisions(spark, d), st.asof()).select("case_id", "ref", "seq", "is_stale")


@query(
    "release_intake",
    """select o_orderkey as id, array_to_string(list_filter([case when o_orderstatus = 'P' and o_totalprice < 20000 then 'missing:summary' end, case when o_totalprice > 450000 then 'unexpected:surprise' end,
    case when o_orderstatus = 'F' and o_totalprice < 30000 then 'decision' end, case when o_orderpriority = '4-NOT SPECIFIED' then 'risk_level' end], lambda x: x is not null), ';') as errors from orders""",
)
def release_intake(spark, d):
    """Release verdict documents written from orders, some with faults."""
    o = st.table(spark, d, "orders")
    price, status = F.col("o_totalprice"), F.col("o_orderstatus")
    text = lambda n: F.lit("x").alias(n)
    empty = lambda n: F.expr("cast(array() as array<string>)").alias(n)
    risk = stats.lookup({"1-URGENT": "CRITICAL", "2-HIGH": "HIGH", "3-MEDIUM": "MEDIUM", "5-LOW": "LOW"}, F.col("o_orderpriority"), F.lit("NONE"))
    body = F.to_json(
        F.struct(
            F.col("o_orderkey").cast("string").alias("case_id"),
            F.when((status == "F") & (price < 30000), "MAYBE").otherwise("REJECT").alias("decision"),
            risk.alias("risk_level"),
            F.when(~((status == "P") & (price < 20000)), "s").alias("summary"),
            empty("reviewed_areas"), empty("blocking_issues"), empty("conditions"), empty("escalations"),
            text("release_safety_checks"), text("recommended_next_step"), text("recommended_reviewer"), empty("approval_notes"),
            F.when(price > 450000, "boo").alias("surprise"),
        )
    )
    rows = quality.release_intake(o.select(F.col("o_orderkey").alias("id"), body.alias("body")))
    return rows.select("id", F.array_join("errors", ";").alias("errors"))


@query(
    "jury_intake",
    """select doc_id, case when toxic = 1 then 'severity' when quality = 0 then 'confidence' else '' end as errors from labels""",
)
def jury_intake(spark, d):
    lab = st.table(spark, d, "labels")
    body = F.to_json(
        F.struct(
            (F.col("toxic") == 1).alias("has_third_party_pii"),
            F.array(F.lit("email")).alias("pii_categories"),
            F.array(F.lit("t")).alias("example_tokens"),
            F.when(F.col("toxic") == 1, "huge").otherwise("low").alias("severity"),
            F.when((F.col("quality") == 0) & (F.col("toxic") == 0), 1.5).otherwise(0.5).alias("confidence"),
            F.lit("r").alias("rationale"),
        )
    )
    rows = quality.jury_intake(lab.select("doc_id", body.alias("body")))
    return rows.select("doc_id", F.array_join("errors", ";").alias("errors"))


def _seals(spark, d):
    """A registry of sealed prompts: a prompt per part brand, a version per part type."""
    parts = st.table(spark, d, "part").groupBy("p_brand", "p_type").agg(F.count(F.lit(1)).alias("n"))
    newest = parts.groupBy("p_brand").agg(F.max("p_type").alias("newest"))
    return parts.join(newest, "p_brand").select(
        F.sha2(F.concat_ws("/", "p_brand", "p_type"), 256).alias("seal"),
        F.col("p_brand").alias("prompt_id"), F.col("p_type").alias("version"), (F.col("p_type") == F.col("newest")).alias("is_current"),
    )


@query(
    "prompt_provenance",
    """with k as (select p_brand, p_type from part group by 1, 2), n as (select p_brand, max(p_type) as newest from part group by 1)
    select status, count(*) as n from (select case when l_discount > 0.09 then 'missing_seal' when l_quantity > 49 then 'unknown_seal' when l_tax > 0.07 then 'prompt_id_mismatch'
    when l_returnflag = 'R' then 'effective_drift' when p_type <> newest then 'older_version' else 'ok' end as status from lineitem join part on l_partkey = p_partkey join n using (p_brand)) group by 1""",
)
def prompt_provenance(spark, d):
    """Verdict rows from order lines; each names the seal of its part's prompt, some wrongly."""
    p = st.table(spark, d, "part").select("p_partkey", "p_brand", "p_type")
    li = st.table(spark, d, "lineitem").join(p, F.col("l_partkey") == F.col("p_partkey"))
    seal = F.sha2(F.concat_ws("/", "p_brand", "p_type"), 256)
    rows = li.select(
        F.when(F.col("l_tax") > 0.07, "other").otherwise(F.col("p_brand")).alias("prompt_id"),
        F.when(F.col("l_discount") > 0.09, "").when(F.col("l_quantity") > 49, "nope").otherwise(seal).alias("seal"),
        F.lit("-").alias("strips"),
        F.when(F.col("l_returnflag") == "R", "bad").otherwise(F.sha2(seal, 256)).alias("effective_sha256"),
        F.lit(False).alias("malformed"),
    )
    reg = _seals(spark, d)
    effective = reg.select("seal", F.lit("-").alias("strips"), F.sha2("seal", 256).alias("effective_sha256"))
    return quality.prompt_provenance(rows, reg, effective).groupBy("status").agg(F.count(F.lit(1)).alias("n"))


@query(
    "fitness_lookup",
    f"""with r as (select o_custkey, max(o_orderkey) as k, arg_max(o_orderstatus, o_orderdate_key) as s, max(o_orderdate) as g, arg_max(o_totalprice, o_orderdate_key) as p
    from (select *, (o_orderdate, 'r-' || o_orderkey) as o_orderdate_key from orders) group by 1)
    select c_custkey as request_id, case when g is null then 'no_matching_report' when epoch(timestamp '{st.ASOF}') - epoch(g) > 1200 * 86400 then 'stale'
    when s = 'P' then 'corpus_drift' when p < 100000 then 'fitness_failed:low' end as reason from customer left join r on o_custkey = c_custkey""",
)
def fitness_lookup(spark, d):
    """A report per order, a request per customer."""
    o = st.table(spark, d, "orders")
    reports = o.select(
        F.col("o_custkey").cast("string").alias("deployment_id"), F.lit("m").alias("model_alias"), F.lit("p").alias("primary_seal"),
        F.lit(None).cast("string").alias("recheck_seal"), F.lit(None).cast("string").alias("params_sha"),
        F.when(F.col("o_orderstatus") == "P", "other").otherwise("corpus").alias("corpus_sha"),
        F.concat(F.lit("r-"), "o_orderkey").alias("report_id"), (F.col("o_totalprice") >= 100000).alias("passed"),
        F.array(F.lit("low")).alias("fails"), F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("generated_at"),
    )
    c = st.table(spark, d, "customer")
    requests = c.select(
        F.col("c_custkey").alias("request_id"), F.col("c_custkey").cast("string").alias("deployment_id"), F.lit("m").alias("model_alias"),
        F.lit("p").alias("primary_seal"), F.lit(None).cast("string").alias("recheck_seal"), F.lit("corpus").alias("corpus_sha"), F.lit("x").alias("params_sha"),
    )
    return quality.fitness_lookup(requests, reports, st.asof(), 1200).select("request_id", "reason")


# ---- digests and chains ----------------------------------------------------

def _tree(rows: str, label: str, digest: str) -> str:
    """CTEs leaf, node and tree: the fixed-depth digest of (case_id, label, digest) rows."""
    return f""", leaf as (select case_id, sha256({label})[1:6] as p, count(*) as n, sha256(string_agg({label} || chr(31) || {digest} || chr(30), '' order by {label})) as h from {rows} group by 1, 2),
    node as (select case_id, p[1:3] as p, sum(n) as n, sha256(string_agg(p || chr(31) || h || chr(30), '' order by p)) as h from leaf group by 1, 2),
    tree as (select case_id, cast(sum(n) as bigint) as n_members, sha256(string_agg(p || chr(31) || h || chr(30), '' order by p)) as set_hash from node group by 1)
    """


@query("set_hash_tree", with_("docs") + _tree("docs", "ref", "sha256(text)") + "select * from tree")
def set_hash_tree(spark, d):
    """The digest of one form at every size."""
    return integrity.set_hash(st.register(spark, d).select("case_id", "ref", "hash"), ["case_id"], "ref", "hash")


@query("set_hash", with_("docs") + _tree("docs", "ref", "sha256(text)") + "select * from tree")
def set_hash(spark, d):
    """The set digest of a case's register, as a tree: no task reads a whole case."""
    return set_hash_tree(spark, d)


@query(
    "stage_hashes",
    with_("docs") + _tree("docs", "ref", "sha256(text)")
    + "select case_id, sha256(set_hash || chr(31) || 'scope ' || case_id || chr(31) || 'thr=0.3' || chr(31) || 'mode=shadow') as upstream_hash from tree",
)
def stage_hashes(spark, d):
    base = set_hash_tree(spark, d)
    return base.select(
        "case_id",
        hashing.params_digest(F.col("set_hash"), F.concat(F.lit("scope "), "case_id"), F.lit("thr=0.3"), F.lit("mode=shadow")).alias("upstream_hash"),
    )


def _freshness(spark, d):
    """Recorded against current digests for two stages; cases past src4 have stale embeddings."""
    digests = cut_lineage(set_hash_tree(spark, d))
    current = digests.select("case_id", F.explode(F.array(F.lit("ingest"), F.lit("embed"))).alias("stage"), F.col("set_hash").alias("upstream_hash"))
    recorded = digests.select(
        "case_id", F.explode(F.array(F.lit("ingest"), F.lit("embed"))).alias("stage"), F.lit(True).alias("present"), F.lit(1).alias("n_rows"), "set_hash"
    )
    drift = (F.col("stage") == "embed") & (F.col("case_id") > "src4")
    manifests = recorded.select("case_id", "stage", "present", "n_rows", F.when(drift, "old").otherwise(F.col("set_hash")).alias("recorded_hash"))
    return integrity.upstream_check(manifests, current)


@query(
    "upstream_check",
    """select source as case_id, stage, case when stage = 'embed' and source > 'src4' then 'hash mismatch' else 'artefact present + hash matches' end as reason,
    not (stage = 'embed' and source > 'src4') as is_fresh from (select distinct source from documents), (values ('ingest'), ('embed')) v(stage)""",
)
def upstream_check(spark, d):
    return _freshness(spark, d)


@query(
    "resume_plan",
    """select source as case_id, stage_idx, coarse, stage_idx >= 1 as will_run from (select distinct source from documents), (values """
    + ", ".join(f"({i}, '{c}')" for i, (c, _) in enumerate(vocab.STAGE_ORDER))
    + ") v(stage_idx, coarse)",
)
def resume_plan(spark, d):
    """Ingest is fresh everywhere; detection has no record, so everything after it runs again."""
    cases = st.table(spark, d, "documents").select(F.col("source").alias("case_id"))
    return integrity.resume_plan(_freshness(spark, d), cases).drop("stale")


RECORD = """, rec as (select *, sha256('{"body":' || to_json(body) || ',"seq":' || seq || '}') as h from audit)"""


@query(
    "chain_emit",
    with_("audit") + RECORD + _tree("rec", "cast(seq as varchar)", "h") + "select case_id, n_members as events, set_hash as head from tree",
)
def chain_emit(spark, d):
    return integrity.chain_heads(integrity.emit_chain(st.audit_events(spark, d), width=1000))


@query(
    "chain_verify",
    with_("audit") + RECORD
    + """, e as (select *, lag(h) over (partition by case_id order by seq) as p from rec), k as (select *, lag(h) over (partition by case_id order by seq) as q from e where event_type <> 'error'),
    s as (select case_id, seq, case when q is null and p is null then 'genesis' when q is null then 'missing_predecessor' when p = q then 'ok' else 'broken' end as status from k)
    select case_id, count(*) as events, count(*) filter (where status in ('broken', 'missing_predecessor')) as breaks, min(seq) filter (where status in ('broken', 'missing_predecessor')) as first_break,
    bool_and(status in ('ok', 'genesis')) as intact from s group by 1""",
)
def chain_verify(spark, d):
    """An emitted chain whose error events are then lost."""
    chain = integrity.emit_chain(st.audit_events(spark, d), width=1000).filter("event_type <> 'error'")
    return integrity.chain_summary(integrity.verify_chain(chain, width=1000))


@query(
    "chain_tamper",
    with_("audit")
    + """, o as (select case_id, seq, row_number() over (partition by case_id order by seq) as i, count(*) over (partition by case_id) as n from audit)
    select case_id, seq, case i when 2 then 'altered' else 'broken' end as status from o where n >= 6 and i in (2, 5)""",
)
def chain_tamper(spark, d):
    """In each case of six events or more the body of the second is changed and the fourth is dropped: exactly
    the second and the one behind the fourth are reported."""
    chain = cut_lineage(integrity.emit_chain(st.audit_events(spark, d), width=1000))
    order = Window.partitionBy("case_id").orderBy("seq")
    at = chain.withColumns({"i": F.row_number().over(order), "n": F.count(F.lit(1)).over(Window.partitionBy("case_id"))})
    changed = at.filter("n >= 6 and i <> 4").withColumn("body", F.when(F.col("i") == 2, F.concat("body", F.lit("!"))).otherwise(F.col("body")))
    return integrity.verify_chain(changed, width=1000).filter("status not in ('ok', 'genesis')").select("case_id", "seq", "status")


@query(
    "chain_gaps",
    """with e as (select event_type as case_id, event_id as seq, lag(event_id) over (partition by event_type order by event_id) as p from events)
    select case_id, p + 1 as expected_seq, seq as found_seq, seq - p - 1 as missing from e where seq - p > 1""",
)
def chain_gaps(spark, d):
    e = st.table(spark, d, "events").select(F.col("event_type").alias("case_id"), F.col("event_id").alias("seq"))
    return integrity.seq_gaps(e, width=1000)


@query(
    "chain_log_orphans",
    with_("audit")
    + """, e as (select case_id, seq, event_type, sha256(body) as event_hash from audit) select case_id, event_hash, 'chain_only' as side from e where event_type = 'signup'
    union all select case_id, event_hash, 'log_only' from e where event_type = 'error'""",
)
def chain_log_orphans(spark, d):
    """Clicks, views and sign-ups are chained; sign-ups never reached the log, views were compensated."""
    e = st.audit_events(spark, d).withColumn("event_hash", hashing.digest(F.col("body")))
    none = F.lit(None).cast("string")
    decided = e.filter("event_type in ('click', 'view', 'signup')").select("case_id", "event_hash", F.lit("reviewer_decision_made").alias("event_type"), none.alias("original_event_hash"))
    repair = e.filter("event_type = 'view'").select("case_id", F.concat(F.lit("f"), "event_hash").alias("event_hash"), F.lit("failure_recorded").alias("event_type"), F.col("event_hash").alias("original_event_hash"))
    return integrity.uncompensated(decided.unionByName(repair), e.filter("event_type in ('click', 'error')"))


@query(
    "corpus_seal",
    with_("docs")
    + """, l as (select d.case_id, d.ref, sha256('{"content":"' || sha256(replace(replace(text, chr(13) || chr(10), chr(10)), chr(13), chr(10))) || '","label":"' || coalesce('q' || quality, '') || '"}') as line, quality
    from docs d left join labels using (doc_id))""" + _tree("l", "ref", "line")
    + """, u as (select case_id, count(*) filter (where quality is null) as unlabelled from l group by 1)
    select case_id, n_members, unlabelled, case when unlabelled = 0 then set_hash end as seal from tree join u using (case_id)""",
)
def corpus_seal(spark, d):
    lab = st.table(spark, d, "labels").select(F.concat(F.lit("doc-"), "doc_id").alias("ref"), F.concat(F.lit("q"), "quality").alias("label"))
    docs = st.docs(spark, d)
    truth = docs.select("case_id", "ref").join(lab, "ref")
    return integrity.corpus_seal(docs, truth)


@query(
    "summary_cache",
    with_("register")
    + """, a as (select case_id, ext, count(*) as n, arg_min(hash, doc_id) as s from register group by 1, 2), k as (select case_id, sha256('ingest|' || string_agg(ext || '|' || n || '|' || s, '|' order by ext))[1:16] as cache_key from a group by 1)
    select case_id, 'ingest' as stage, cache_key, case_id < 'src3' as hit from k""",
)
def summary_cache(spark, d):
    reg = st.register(spark, d)
    arts = reg.groupBy("case_id", F.regexp_extract("filename", r"\.(\w+)$", 1).alias("name")).agg(
        F.count(F.lit(1)).alias("line_count"), F.min_by("hash", "doc_id").alias("sample_sha")
    )
    keys = integrity.cache_keys(arts.withColumn("stage", F.lit("ingest")))
    stored = keys.select("case_id", "stage", F.lit(1).alias("seq"), F.when(F.col("case_id") < "src3", F.col("cache_key")).otherwise("old").alias("cache_key"))
    return integrity.cache_hits(keys, stored).select("case_id", "stage", "cache_key", "hit")


@query(
    "parameter_digest",
    """select source as case_id, sha256('{"max_text_chars":' || max(n_chars) || ',"model_alias":"' || source || '"}') as digest from documents group by source""",
)
def parameter_digest(spark, d):
    rows = st.table(spark, d, "documents").groupBy(F.col("source").alias("case_id")).agg(F.max("n_chars").alias("n"))
    return rows.select("case_id", hashing.json_digest(model_alias=F.col("case_id"), max_text_chars=F.col("n")).alias("digest"))


# ---- unions and the feed ---------------------------------------------------


@query(
    "multi_source_union",
    """select 'events' as source, cast(event_id as varchar) as item, event_type as kind, cast(null as varchar) as status, cast(ts as date) as day from events
    union all select 'orders', cast(o_orderkey as varchar), null, o_orderstatus, cast(o_orderdate as date) from orders""",
)
def multi_source_union(spark, d):
    e = st.table(spark, d, "events").select(
        F.lit("events").alias("source"), F.col("event_id").cast("string").alias("item"), F.col("event_type").alias("kind"), F.to_date("ts").alias("day")
    )
    o = st.table(spark, d, "orders").select(
        F.lit("orders").alias("source"), F.col("o_orderkey").cast("string").alias("item"), F.col("o_orderstatus").alias("status"), F.to_date("o_orderdate").alias("day")
    )
    return e.unionByName(o, allowMissingColumns=True)


@query(
    "replay_window",
    """select e.event_id, e.event_type from events e join (select event_type, date_trunc('second', max(ts)) as t from events group by 1) n using (event_type)
    where date_trunc('second', e.ts) >= n.t - interval 3600 second""",
)
def replay_window(spark, d):
    """The last hour before each type's newest event, which stands for the present."""
    e = st.table(spark, d, "events").select("event_id", "event_type", "ts")
    newest = e.groupBy("event_type").agg(F.max("ts").alias("asof"))
    rows = e.join(newest, "event_type")
    return feed.replay(rows, F.col("asof"), 3600, "ts").select("event_id", "event_type")


def _raw_events():
    """Log lines from events: known and unknown types, some with wrong values. Column expressions only."""
    t, k = F.col("event_type"), F.get_json_object("props", "$.k").cast("int")
    name = stats.lookup({"click": "stage_end", "view": "REDACT_COMPLETED", "purchase": "note", "signup": "stage_skipped", "error": "SECRET_EVENT"}, t)
    payload = F.to_json(
        F.struct(
            F.when(k < 80, "redact").otherwise("made_up").alias("stage"),
            F.col("value").alias("duration_s"),
            k.alias("refs_processed"),
            (k * 1_000_000).alias("redactions_applied"),
            F.when(k < 50, "info").otherwise("loud").alias("kind"),
            F.lit("manual_skip").alias("reason"),
            F.col("props").alias("free_text"),
        )
    )
    return [
        F.concat(F.lit("u"), "user_id").alias("case_id"),
        F.when(t == "click", "L3").otherwise("L1").alias("source"),
        F.when(k < 95, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")).otherwise("yesterday").alias("ts"),
        name.alias("event_type"),
        payload.alias("payload"),
        F.col("event_id").alias("event_id"),
    ]


PROJECTED = (
    "with e as (select 'u' || user_id as case_id, event_id, event_type as t, value, ts, cast(json_extract_string(props, '$.k') as int) as k from events), "
    "p as (select *, case when k < 80 then 'redact' else '<typeerror>' end as s, case when k < 50 then 'info' else '<typeerror>' end as kd, "
    "case when k <= 10 then cast(k * 1000000 as varchar) else '<typeerror>' end as ra from e) "
    "select case_id, event_id, 'event' as kind, case when k < 95 then strftime(ts, '%Y-%m-%dT%H:%M:%SZ') else '<typeerror>' end as ts, case when t = 'click' then 'L3' else 'L1' end as source, "
    "case t when 'click' then 'stage_end' when 'view' then 'REDACT_COMPLETED' when 'purchase' then 'note' when 'signup' then 'stage_skipped' end as event_type, "
    "case when t in ('click', 'view', 'signup') then s end as stage, case when t <> 'error' then 'info' end as severity, "
    "case t when 'click' then 'stage ended: ' || s || ' (' || cast(value as varchar) || 's)' when 'view' then 'redacted ' || ra || ' of ' || k || ' refs' when 'purchase' then 'note (' || kd || ')' "
    "when 'signup' then 'stage skipped: ' || s || ' (manual_skip)' else '(unrecognised event type)' end as summary from p"
)


@query("event_projection", PROJECTED)
def event_projection(spark, d):
    events = st.spread(st.table(spark, d, "events"), "event_id")
    return projection.project(events.select(*_raw_events()), keep=["case_id", "event_id"])


def _landed(spark, d, files: int = 4):
    """The events table as a stream of several files, one a batch, each with events from all over the table."""
    rows, folder = st.table(spark, d, "events"), run_folder(spark, "landed")
    rows.withColumn("f", F.pmod(F.xxhash64("event_id"), F.lit(files))).repartition(files, "f").sortWithinPartitions("event_id").drop("f").write.parquet(folder)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(folder)


def _event_stream(spark, d):
    """The events table as a stream of files."""
    schema = st.table(spark, d, "events").schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 100).parquet(os.path.join(d, "events.parquet*"))


@query("stream_projection", PROJECTED)
def stream_projection(spark, d):
    """The same projection in a stream; must equal the batch."""
    out, check = run_folder(spark, "projection"), run_folder(spark, "ckpt")
    rows = projection.project(_event_stream(spark, d).select(*_raw_events()), keep=["case_id", "event_id"])
    q = rows.writeStream.format("parquet").option("checkpointLocation", check).option("path", out).trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.parquet(out)


def _stream_decisions(spark, d):
    m = F.create_map(*[F.lit(x) for p in st.DECISION_OF.items() for x in p])
    return _landed(spark, d).select(
        F.concat(F.lit("k"), F.get_json_object("props", "$.k")).alias("case_id"), F.concat(F.lit("doc-"), "user_id").alias("ref"),
        F.col("event_id").alias("seq"), F.try_element_at(m, "event_type").alias("decision"),
    )


STREAM = "with s as (select 'k' || json_extract_string(props, '$.k') as case_id, 'doc-' || user_id as ref, event_id as seq, " + st._case_sql(st.DECISION_OF) + " as decision from events) "


@query(
    "stream_funnel",
    STREAM + "select case_id, count(*) as decisions, cast(0 as bigint) as leak_excluded, count(*) filter (where decision <> 'pending') as decided from s group by 1",
)
def stream_funnel(spark, d):
    out, check = run_folder(spark, "funnel"), run_folder(spark, "ckpt")
    feed.append_updates(feed.funnel_updates(_stream_decisions(spark, d)), out, check).awaitTermination()
    return feed.current_state(spark, out, ["case_id"]).drop("batch_id")


@query("stream_latest_decision", STREAM + "select case_id, ref, max(seq) as seq, arg_max(decision, seq) as decision from s group by 1, 2")
def stream_latest_decision(spark, d):
    out, check = run_folder(spark, "latest"), run_folder(spark, "ckpt")
    feed.latest_decisions_stream(_stream_decisions(spark, d), out, check).awaitTermination()
    return feed.current_state(spark, out, ["case_id", "ref"], "seq").drop("batch_id")


@query(
    "stream_gaps",
    """with e as (select event_type as case_id, event_id as seq, lag(event_id) over (partition by event_type order by event_id) as p from events)
    select case_id, 'events' as source, p + 1 as expected_seq, seq as found_seq, seq - p - 1 as missing from e where seq - p > 1""",
)
def stream_gaps(spark, d):
    watch.use_rocksdb(spark)
    out, check = run_folder(spark, "gaps"), run_folder(spark, "ckpt")
    rows = _landed(spark, d).select(F.col("event_type").alias("case_id"), F.lit("events").alias("source"), F.col("event_id").alias("seq"))
    q = watch.gap_stream(rows, width=1000).writeStream.format("parquet").option("checkpointLocation", check).option("path", out).trigger(availableNow=True).start()
    q.awaitTermination()
    return watch.open_gaps(spark.read.schema(watch.GAPS).parquet(out))
