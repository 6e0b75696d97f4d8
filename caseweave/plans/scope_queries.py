"""Scope, verdicts, fitness, truncation, model replies."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import replies, stats, text as tx, vocab
from ..operators import quality, scope, scorers
from . import standins as st
from .registry import query
from .standins import with_

# ---- vectors ---------------------------------------------------------------


def _embeddings(spark, d):
    return st.table(spark, d, "embeddings").select(
        F.concat(F.lit("c"), "label").alias("case_id"), F.concat(F.lit("vec-"), "vec_id").alias("ref"), "vec_id", "embedding"
    )


def _scopes(spark, d):
    """The first vector of each case stands for its scope statement."""
    return _embeddings(spark, d).groupBy("case_id").agg(F.min_by("embedding", "vec_id").alias("scope_vector"))


SCORED = (
    "with e as (select 'c' || label as case_id, 'vec-' || vec_id as ref, vec_id, cast(embedding as double[]) as v from embeddings), "
    "q as (select case_id, arg_min(v, vec_id) as sv from e group by 1), "
    "s as (select case_id, ref, list_cosine_similarity(v, sv) as score from e join q using (case_id)) "
)


@query(
    "scope_prefilter",
    SCORED
    + """select case_id, ref, round(score, 6) as cosine_score, case when score >= 0.30 then 'in_scope_candidate' else 'not_relevant' end as verdict, score >= 0.30 as passes from s""",
)
def scope_prefilter(spark, d):
    out = scope.scope_prefilter(_embeddings(spark, d), _scopes(spark, d))
    return out.select("case_id", "ref", F.round("cosine_score", 6).alias("cosine_score"), "verdict", "passes")


@query(
    "vector_search",
    SCORED
    + """select case_id, ref, round(score, 6) as score, rank from (select *, row_number() over (partition by case_id order by score desc, ref) as rank from s) where rank <= 10""",
)
def vector_search(spark, d):
    out = scope.vector_search(_embeddings(spark, d), _scopes(spark, d), k=10)
    return out.select("case_id", "ref", F.round("score", 6).alias("score"), "rank")


@query(
    "prefilter_checks",
    """select 'c' || label as case_id, c as "check", count(*) as n_rows, cast(0 as bigint) as n_bad, 'info' as severity
    from embeddings, (values ('embed_fields'), ('embed_dim'), ('embed_nan')) v(c) group by 1, 2""",
)
def prefilter_checks(spark, d):
    return quality.check_embeddings(_embeddings(spark, d).withColumn("upstream_hash", F.lit("h")), 64)


def _overlap():
    """Lexical stand-in for a reranker: the share of the scope's words a text holds."""

    def score(scopes: list[str], texts: list[str]) -> list[float]:
        out = []
        for s, t in zip(scopes, texts):
            words = set(s.split(" "))
            out.append(len(words & set(t.split(" "))) / len(words))
        return out

    return score


RERANK = with_("docs") + (
    ", q as (select case_id, min(text) as scope_text from docs group by 1), "
    "s as (select case_id, ref, len(list_intersect(list_distinct(string_split(text, ' ')), list_distinct(string_split(scope_text, ' '))))::double / "
    "len(list_distinct(string_split(scope_text, ' '))) as score from docs join q using (case_id)) "
)


@query(
    "rerank_shadow",
    RERANK + "select case_id, ref, round(score, 6) as rerank_score, score < 0.1 as would_drop, 'shadow' as mode from s",
)
def rerank_shadow(spark, d):
    docs = st.docs(spark, d)
    scopes = docs.groupBy("case_id").agg(F.min("text").alias("scope_text"))
    scored = scorers.rerank_scores(docs.join(scopes, "case_id"), _overlap)
    return scope.rerank(scored, 0.1).withColumn("rerank_score", F.round("rerank_score", 6))


@query("rerank_enforce", RERANK + "select case_id, ref from s where score >= 0.1")
def rerank_enforce(spark, d):
    docs = st.docs(spark, d)
    scopes = docs.groupBy("case_id").agg(F.min("text").alias("scope_text"))
    scored = scorers.rerank_scores(docs.join(scopes, "case_id"), _overlap)
    return scope.rerank(scored, 0.1, "enforce").select("case_id", "ref")


# ---- verdicts --------------------------------------------------------------


@query(
    "verdict_strata",
    with_("verdicts", "rechecks")
    + """select case_id, ref, primary_verdict, recheck_verdict, case when primary_verdict = 'work_context_only' and recheck_verdict = 'reclassify_to_biographical' then 'disputed_recheck_says_bio'
    when primary_verdict = 'work_context_only' and recheck_verdict = 'confirmed_work_context_only' then 'agreed_work_context_only'
    when recheck_verdict = 'reclassify_to_ambiguous' then 'recheck_ambiguous' when primary_verdict = 'biographical' then 'originally_biographical' end as stratum
    from verdicts left join (select case_id, ref, recheck_verdict from rechecks) using (case_id, ref)""",
)
def verdict_strata(spark, d):
    return scope.verdict_strata(st.verdicts(spark, d), st.rechecks(spark, d), st.register(spark, d))


def _operator_calls(spark, d):
    """An operator decision per document of more than 200 characters, by its length."""
    n = F.col("n_chars")
    call = F.when(n > 3000, "yes").when(n > 1000, "no").when(n > 400, "uncertain").otherwise("skip")
    return st.verdicts(spark, d).filter("n_chars > 200").select("case_id", "ref", "seq", call.alias("verdict"))


@query(
    "agreement_report",
    with_("verdicts", "rechecks")
    + """, s as (select v.case_id, case when primary_verdict = 'work_context_only' and recheck_verdict = 'reclassify_to_biographical' then 'disputed_recheck_says_bio'
    when primary_verdict = 'work_context_only' and recheck_verdict = 'confirmed_work_context_only' then 'agreed_work_context_only'
    when recheck_verdict = 'reclassify_to_ambiguous' then 'recheck_ambiguous' when primary_verdict = 'biographical' then 'originally_biographical' end as stratum,
    case when v.n_chars > 3000 then 'include' when v.n_chars > 1000 then 'exclude' when v.n_chars > 400 then 'uncertain' when v.n_chars > 200 then 'skip' end as op,
    case primary_verdict when 'biographical' then 'include' when 'work_context_only' then 'exclude' else 'uncertain' end as p,
    case recheck_verdict when 'reclassify_to_biographical' then 'include' when 'confirmed_work_context_only' then 'exclude' else 'uncertain' end as r
    from verdicts v left join rechecks r using (case_id, ref)), t as (select * from s where stratum is not null)
    select case_id, case when grouping(stratum) = 1 then 'overall' else stratum end as stratum, count(*) as sampled, count(op) as decided,
    count(*) filter (where op = p) as agree_primary, count(*) filter (where op = r) as agree_recheck from t group by grouping sets ((case_id, stratum), (case_id))""",
)
def agreement_report(spark, d):
    strata = scope.verdict_strata(st.verdicts(spark, d), st.rechecks(spark, d), st.register(spark, d))
    return scope.agreement_report(strata.filter("stratum is not null"), _operator_calls(spark, d))


def synthesised(spark, d):
    return scope.synthesise(st.verdicts(spark, d), st.rechecks(spark, d), st.temporal(spark, d))


@query(
    "verdict_synthesis",
    with_("synth")
    + """select case_id, ref, eff as effective, reason, scope_verdict, case when out and eff = 'present' then 'durant=present (' || reason || ') vs temporal=out_of_scope; operator should reconcile'
    when out and eff = 'ambiguous' then 'durant=ambiguous (' || reason || ') + temporal=out_of_scope' when out then 'effective_durant=not_present (' || reason || '); temporal=out_of_scope'
    when eff = 'ambiguous' then 'effective_durant=ambiguous (' || reason || '), temporal=' || coalesce(temporal_verdict, 'None')
    else 'effective_durant=' || eff || ' (' || reason || ')' end as decision_rationale from synth""",
)
def verdict_synthesis(spark, d):
    return synthesised(spark, d).select("case_id", "ref", "effective", "reason", "scope_verdict", "decision_rationale")


def _n(cond: str, name: str) -> str:
    return f"count(*) filter (where {cond}) as {name}"


@query(
    "synthesis_summary",
    with_("synth")
    + "select case_id, "
    + ", ".join(
        [_n(f"primary_scope = '{v}'", f"primary_{v}") for v in ("present", "not_present", "ambiguous")]
        + [
            _n("reason = 'recheck_reclassified_biographical'", "recheck_promoted"),
            _n("reason = 'recheck_reclassified_ambiguous'", "recheck_escalated"),
            _n("reason = 'recheck_confirms_wco'", "recheck_confirmed"),
            _n("starts_with(reason, 'recheck_errored:')", "recheck_errored"),
            _n("reason = 'recheck_expected_but_missing_for_ref'", "recheck_missing_anomaly"),
            "cast(0 as bigint) as primary_wco_recheck_disabled, cast(0 as bigint) as recheck_other",
        ]
        + [_n(f"scope_verdict = '{v}'", f"scope_{v}") for v in ("present", "not_present", "ambiguous")]
        + [_n("out", "temporal_out_blocked"), _n("out and reason = 'recheck_reclassified_biographical'", "temporal_recheck_conflict")]
    )
    + " from synth group by 1",
)
def synthesis_summary(spark, d):
    return scope.synthesis_summary(synthesised(spark, d))


@query(
    "recheck_summary",
    with_("rechecks")
    + """select case_id, 'always' as mode_effective, count(*) as docs_examined,
    count(*) filter (where error_code is null and recheck_verdict = 'reclassify_to_biographical') as docs_reclassified_to_biographical,
    count(*) filter (where error_code is null and recheck_verdict = 'reclassify_to_ambiguous') as docs_reclassified_to_ambiguous,
    count(*) filter (where error_code is null and recheck_verdict = 'confirmed_work_context_only') as docs_confirmed_wco,
    count(*) filter (where error_code is not null) as errors from rechecks group by 1""",
)
def recheck_summary(spark, d):
    return scope.recheck_summary(st.rechecks(spark, d))


def _labelled(spark, d):
    """Truth from the labels, a gate that follows text length, errors on the longest texts."""
    n = F.col("n_chars")
    gate = F.when(n > 700, "biographical").when(n > 300, "work_context_only").otherwise("ambiguous")
    return st.verdicts(spark, d).select(
        "lang", F.col("primary_verdict").alias("truth"), gate.alias("gate"), F.when(n > 9000, "timeout").alias("error_code")
    )


def _wilson(k: str, n: str, sign: str) -> str:
    z = vocab.WILSON_Z
    centre = f"({k} / nullif({n}, 0)::double + {z * z}::double / (2 * {n}))"
    spread = f"({z}::double * sqrt(({k} / nullif({n}, 0)::double) * (1 - {k} / nullif({n}, 0)::double) / {n} + {z * z}::double / (4.0::double * {n} * {n})))"
    bound = f"(({centre}) {sign} {spread}) / (1 + {z * z}::double / {n})"
    clip = f"greatest(0.0::double, {bound})" if sign == "-" else f"least(1.0::double, {bound})"
    return f"case when {n} > 0 then round({clip}, 6) end"


@query(
    "fitness_report",
    with_("verdicts")
    + f""", r as (select lang, primary_verdict as truth, case when n_chars > 700 then 'biographical' when n_chars > 300 then 'work_context_only' else 'ambiguous' end as gate, n_chars <= 9000 as ok from verdicts),
    c as (select lang, count(*) as corpus_size, count(*) filter (where ok) as ns, count(*) filter (where ok and truth = 'biographical') as nb, count(*) filter (where ok and truth = 'work_context_only') as nw,
    count(*) filter (where truth = 'biographical') as tb, count(*) filter (where truth = 'work_context_only') as tw,
    count(*) filter (where ok and gate = truth) as na, count(*) filter (where ok and truth = 'biographical' and gate = 'work_context_only') as nfn,
    count(*) filter (where ok and truth = 'work_context_only' and gate = 'biographical') as nfp, count(*) filter (where ok and truth <> 'ambiguous' and gate = 'ambiguous') as nam from r group by 1),
    m as (select *, ns / corpus_size::double as success_rate, {_wilson('na', 'ns', '-')} as agreement_wilson_lower, {_wilson('nfn', 'nb', '+')} as fn_rate_wilson_upper, {_wilson('nfp', 'nw', '+')} as fp_rate_wilson_upper,
    case when nb + nw > 0 then nam / (nb + nw)::double end as amb from c)
    select lang, corpus_size, round(success_rate, 6) as success_rate, agreement_wilson_lower, fn_rate_wilson_upper, fp_rate_wilson_upper, round(amb, 6) as ambiguous_rate,
    array_to_string(list_filter([case when corpus_size < 30 then 'corpus:corpus_size_below_minimum' end,
    case when tb < 12 then 'corpus:corpus_biographical_class_below_minimum' end, case when tb >= 12 and nb = 0 then 'model:biographical_class_all_errored' end,
    case when tw < 12 then 'corpus:corpus_work_context_only_class_below_minimum' end, case when tw >= 12 and nw = 0 then 'model:work_context_only_class_all_errored' end,
    case when success_rate < 0.85 then 'model:success_rate_below_minimum' end, case when agreement_wilson_lower < 0.8 then 'model:agreement_wilson_lower_below_threshold' end,
    case when fn_rate_wilson_upper > 0.2 then 'model:fn_wilson_upper_above_threshold' end, case when fp_rate_wilson_upper > 0.2 then 'model:fp_wilson_upper_above_threshold' end,
    case when amb > 0.2 then 'model:ambiguous_rate_above_threshold' end], lambda x: x is not null), ',') as fails from m""",
)
def fitness_report(spark, d):
    out = scope.fitness_report(_labelled(spark, d), ["lang"])
    rounded = [F.round(c, 6).alias(c) for c in ("success_rate", "agreement_wilson_lower", "fn_rate_wilson_upper", "fp_rate_wilson_upper")]
    return out.select(
        "lang", "corpus_size", *rounded, F.round("ambiguous_rate_on_definite_truth", 6).alias("ambiguous_rate"), F.array_join("fails", ",").alias("fails")
    )


@query(
    "recheck_gate",
    with_("verdicts")
    + f""", k as (select case_id, count(*) as n, count(*) filter (where n_chars <= 500) as f, max(doc_id) as last from verdicts where primary_verdict = 'biographical' group by 1),
    e as (select case_id, timestamp '2023-06-01' + to_days(cast(last // 10 as int)) as "at", least(1.0::double, greatest(f / n::double, {_wilson('f', 'n', '+')})) as hi, case when f > 2 then 'seal-b' else 'seal-a' end as seal from k),
    q as (select case_id as request_id, case when count(*) > 24 then 'always' when count(*) < 15 then 'never' else 'auto' end as mode from verdicts group by 1)
    select request_id, mode as mode_requested, case when mode = 'never' or reason = 'ci_upper_below_threshold' then 'never' else 'always' end as mode_effective, reason from (
    select request_id, mode, case when mode <> 'auto' then 'mode_set_explicit' when e.at is null then 'calibration_cache_miss'
    when epoch(timestamp '{st.ASOF}') - epoch(e.at) > 200 * 86400 then 'calibration_stale' when seal <> 'seal-a' then 'calibration_prompt_seal_drift'
    when hi > 0.30 then 'ci_upper_above_threshold' else 'ci_upper_below_threshold' end as reason from q left join e on e.case_id = q.request_id)""",
)
def recheck_gate(spark, d):
    """Requests per case; registry entries from the labelled biographical documents of each."""
    v = st.verdicts(spark, d)
    k = v.filter("primary_verdict = 'biographical'").groupBy("case_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("n_chars") <= 500).alias("f"), F.max("doc_id").alias("last")
    )
    hi = F.least(F.lit(1.0), F.greatest(F.col("f") / F.col("n"), F.round(stats.wilson(F.col("f"), F.col("n"))[1], 6)))
    at = F.to_timestamp(F.date_add(F.to_date(F.lit("2023-06-01")), F.floor(F.col("last") / 10).cast("int")))
    registry = k.select(
        F.col("case_id").alias("deployment_id"), F.lit("m").alias("model_alias"),
        F.when(F.col("f") > 2, " SEAL-B").otherwise(" SEAL-A").alias("primary_seal"), F.lit("s").alias("recheck_seal"),
        at.alias("calibrated_at"), F.col("n").alias("sample_size"), F.col("case_id").alias("source_case_id"),
        (F.col("f") / F.col("n")).alias("fn_rate"), F.lit(0.0).alias("ci_lower"), hi.alias("ci_upper"),
    )
    n = F.count(F.lit(1))
    requests = v.groupBy("case_id").agg(F.when(n > 24, "always").when(n < 15, "never").otherwise("auto").alias("mode")).select(
        F.col("case_id").alias("request_id"), F.col("case_id").alias("deployment_id"), F.lit("m").alias("model_alias"), "mode",
        F.lit("seal-a").alias("primary_seal"), F.lit("s").alias("recheck_seal"),
    )
    return scope.recheck_gate(requests, registry, st.asof(), 0.30, 200).drop("ci_upper")


@query(
    "model_cost",
    """with c as (select 'conv-' || conv_id as case_id, role as stage, length(text) as tin, turn * 10 as tout from conversations)
    select case_id, stage, count(*) as calls, count(*) filter (where stage = 'system') as unpriced_calls,
    round(sum(case stage when 'user' then tin * 0.015::double / 1000 + tout * 0.075::double / 1000 when 'assistant' then tin * 0.001::double / 1000 + tout * 0.002::double / 1000 end), 6) as cost_usd
    from c group by 1, 2""",
)
def model_cost(spark, d):
    calls = st.table(spark, d, "conversations").select(
        F.concat(F.lit("conv-"), "conv_id").alias("case_id"), F.col("role").alias("stage"), F.col("role").alias("model_alias"),
        F.char_length("text").alias("input_tokens"), (F.col("turn") * 10).alias("output_tokens"),
    )
    prices = spark.createDataFrame(
        [("user", 0.015, 0.075), ("assistant", 0.001, 0.002)], "model_alias string, in_per_1k double, out_per_1k double"
    )
    return scope.model_cost(calls, prices)


@query(
    "tag_scope",
    with_("synth", "dispositions")
    + """select case_id, ref from synth where scope_verdict in ('present', 'ambiguous') and case_id < 'src5' union
    select case_id, ref from dispositions where disposition = 'included' and case_id not in (select case_id from synth where case_id < 'src5')""",
)
def tag_scope(spark, d):
    """Cases that sort from src5 on play the part of cases whose verdicts are still missing."""
    docs = st.docs(spark, d).select("case_id", "ref")
    return scope.tag_scope(docs, synthesised(spark, d).filter("case_id < 'src5'"), st.dispositions(spark, d))


@query(
    "scope_discrepancy",
    with_("synth", "dispositions")
    + """select case_id, ref from synth where scope_verdict in ('present', 'ambiguous') intersect select case_id, ref from dispositions where disposition = 'excluded'""",
)
def scope_discrepancy(spark, d):
    return scope.scope_discrepancies(synthesised(spark, d), st.dispositions(spark, d))


@query(
    "in_scope_positive",
    with_("synth") + "select case_id, count(*) as n from synth where scope_verdict = 'present' group by 1",
)
def in_scope_positive(spark, d):
    return synthesised(spark, d).filter(F.col("scope_verdict").isin(*vocab.IN_SCOPE_POSITIVE)).groupBy("case_id").agg(F.count(F.lit(1)).alias("n"))


@query(
    "pending_work",
    with_("docs", "rechecks") + "select case_id, ref from docs where ref not in (select ref from rechecks where error_code is null)",
)
def pending_work(spark, d):
    done = st.rechecks(spark, d).withColumnRenamed("error_code", "error_state")
    return scope.pending_work(st.docs(spark, d).select("case_id", "ref"), done)


# ---- truncation and cleaning -----------------------------------------------

CAP = 1200
FRAME = len(vocab.ELIDED % "")


def _head_tail_sql(text: str, src: str, extra: str = "") -> str:
    """The same fixed point in SQL: four rounds of the marker's digit count."""
    base = CAP - FRAME
    before, after = (x.replace("\n", "' || chr(10) || '") for x in vocab.ELIDED.split("%s"))
    dig = "1"
    for _ in range(4):
        dig = f"length(cast(greatest(0, n - ({base} - {dig})) as varchar))"
    return (
        f"select *, case when n <= {CAP} then {text} else {text}[1:head] || '{before}' || greatest(0, n - ({base} - dg)) || '{after}' || {text}[n - (avail - head) + 1:n] end as cut, "
        f"case when n <= {CAP} then 'none' else 'head_tail' end as mode, case when n <= {CAP} then n else head end as e_start, case when n <= {CAP} then n else n - (avail - head) end as e_end "
        f"from (select *, cast(floor(avail * 0.75::double) as bigint) as head from (select *, {base} - dg as avail from (select *, {dig} as dg from (select {extra}*, length({text}) as n from {src}))))"
    )


@query(
    "head_tail_truncate",
    with_("docs")
    + f"select case_id, ref, mode, e_start as elided_start, e_end as elided_end, sha256(cut) as digest from ({_head_tail_sql('text', 'docs')})",
)
def head_tail_truncate(spark, d):
    cut = tx.head_tail(F.col("text"), CAP)
    return st.docs(spark, d).select("case_id", "ref", cut.alias("c")).select(
        "case_id", "ref", "c.mode",
        F.col("c.elided_start").cast("bigint").alias("elided_start"),
        F.col("c.elided_end").cast("bigint").alias("elided_end"),
        F.sha2("c.text", 256).alias("digest"),
    )


@query(
    "elided_mentions",
    with_("docs", "subjects")
    + f"""select case_id, ref, cast((length(mid) - length(replace(mid, lower(full_name), ''))) // length(full_name) + coalesce((length(mid) - length(replace(mid, lower(email), ''))) // length(email), 0)
    + (length(mid) - length(replace(mid, lower(alias), ''))) // length(alias) as bigint) as mentions
    from (select *, lower(text[e_start + 1:e_end]) as mid from ({_head_tail_sql('text', 'docs')}) where mode = 'head_tail') join subjects using (case_id)""",
)
def elided_mentions(spark, d):
    """How often each subject is named in what truncation leaves out."""
    cut = tx.head_tail(F.col("text"), CAP)
    rows = st.docs(spark, d).select("case_id", "ref", "text", cut.alias("c")).filter("c.mode = 'head_tail'").join(st.subjects(spark, d), "case_id")
    ids = F.concat(F.array("full_name", "email"), "aliases")
    n = tx.elided_mentions(F.col("text"), F.col("c.elided_start"), F.col("c.elided_end"), ids)
    return rows.select("case_id", "ref", n.cast("bigint").alias("mentions"))


def _threads(spark, d):
    """Each document as a mail thread: its lines are messages."""
    head = F.lit("From: a@example.com\nSubject: s\n")
    return st.docs(spark, d).select(
        "case_id", "ref", F.concat(head, F.replace("text", F.lit("\n"), F.lit("\nOn Monday someone wrote:\n"))).alias("text")
    )


WROTE = "On Monday someone wrote:"


@query(
    "thread_truncate",
    with_("docs")
    + ", t as (select case_id, ref, 'From: a@example.com' || chr(10) || 'Subject: s' || chr(10) || replace(text, chr(10), chr(10) || 'On Monday someone wrote:' || chr(10)) as text from docs), "
    + f"h as ({_head_tail_sql('text', 't')}), "
    + f"""j as (select *, strpos(text, '{WROTE}') - 1 as b, n - strpos(reverse(text), reverse('{WROTE}')) + 1 - {len(WROTE)} as l from h),
    k as (select *, regexp_replace(text[1:b], '\\s+$', '') || chr(10) || chr(10) || '[... ' || (l - b) || ' characters elided from middle of thread ...]' || chr(10) || chr(10) || regexp_replace(text[l + 1:n], '^\\s+', '') as joined from j)
    select case_id, ref, case when is_two then 'structure_aware_email_2msg' else mode end as mode, sha256(case when is_two then joined else cut end) as digest
    from (select *, n > {CAP} and b >= 0 and l > b and length(joined) <= {CAP} as is_two from k)""",
)
def thread_truncate(spark, d):
    rows = _threads(spark, d).select("case_id", "ref", tx.thread_cut(F.col("text"), CAP).alias("c"))
    return rows.select("case_id", "ref", "c.mode", F.sha2("c.text", 256).alias("digest"))


@query(
    "head_cap",
    with_("docs")
    + r"""select case_id, ref, sha256(text[1:6000]) as digest, case when length(text) > 6000 then chr(10) || '[truncated from ' || length(text) || ' to 6000 chars]' else '' end as note from docs""",
)
def head_cap(spark, d):
    body, note = tx.head_cap(F.col("text"), 6000)
    return st.docs(spark, d).select("case_id", "ref", F.sha2(body, 256).alias("digest"), note.alias("note"))


@query(
    "text_clean",
    r"""with t as (select conv_id, turn, text, trim(regexp_replace(regexp_replace(text, '[^\S\t]+', ' ', 'g'), '[\p{Cc}]', '', 'g')) as v from conversations),
    e as (select *, case when length(text) > 2000 then 'raw_too_long' when length(v) > 500 then 'too_long'
    when regexp_matches(v, '(?i)\bignore\s+(?:previous|prior|above)\s+(?:instructions?|prompt|system)\b|\b(?:system|assistant|human|user)\b[\s>#*_`~\-]*:|<\|[^|]*\|>') then 'injection' end as error from t)
    select conv_id, turn, error, case when error is null and v <> '' then sha256(v) end as digest from e""",
)
def text_clean(spark, d):
    """Conversation turns as free-text role context: cleaned, or refused with the reason."""
    rows = st.table(spark, d, "conversations").select("conv_id", "turn", F.col("text"), tx.nfkc("text").alias("norm"))
    out = rows.select("conv_id", "turn", tx.clean_role(F.col("text"), F.col("norm"), vocab.ROLE_CAPS["role_context"]).alias("c"))
    return out.select("conv_id", "turn", "c.error", F.sha2("c.value", 256).alias("digest"))


def _scrub_sql(col: str) -> str:
    out = f"{col}[1:{vocab.RAW_INPUT_CAP}]"
    for p in vocab.CREDENTIALS:
        out = f"regexp_replace({out}, '{p}', '[REDACTED]', 'g')"
    return f"{out}[1:{vocab.RAW_OUTPUT_CAP}]"


@query("credential_scrub", with_("docs") + f"select case_id, ref, sha256({_scrub_sql('text')}) as digest from docs")
def credential_scrub(spark, d):
    return st.docs(spark, d).select("case_id", "ref", F.sha2(tx.scrub_credentials(F.col("text")), 256).alias("digest"))


# ---- model replies ---------------------------------------------------------


def _reply():
    """Stand-in model: answers by the length of the prompt, sometimes badly, sometimes not at all."""
    import json

    def answer(prompts: list[str]) -> list[str | None]:
        out: list[str | None] = []
        for p in prompts:
            n = len(p)
            if n < 100:
                out.append(None)
            elif n < 200:
                out.append("")
            elif n < 400:
                out.append("I cannot say {oops")
            else:
                word = "biographical" if n > 2000 else "work_context_only" if n > 1000 else "maybe"
                body = json.dumps({"durant_verdict": word, "rationale": p, "confidence": 1.5 if n > 3000 else "0.25", "is_about_requester": "yes"})
                out.append(f"```json\n{body}\n```" if n > 1500 else f"Here: {body} done")
        return out

    return answer


@query(
    "reply_coercion",
    with_("docs")
    + """select case_id, ref, case when n > 2000 then 'biographical' when n > 1000 then 'work_context_only' else 'ambiguous' end as primary_verdict,
    case when n < 100 then 'model_unreachable' when n < 200 then 'empty_response' when n < 400 then 'schema_validation_failed' end as error_state,
    case when n >= 400 then sha256(text[1:600]) end as rationale_digest from (select *, length(text) as n from docs)""",
)
def reply_coercion(spark, d):
    prompts = st.docs(spark, d).withColumnRenamed("text", "prompt")
    rows = scorers.chat(prompts, _reply).select("case_id", "ref", replies.primary_row(F.col("reply"), F.col("reachable")).alias("r"))
    return rows.select("case_id", "ref", "r.primary_verdict", "r.error_state", F.sha2("r.rationale", 256).alias("rationale_digest"))


@query(
    "context_coercion",
    with_("docs")
    + """select case_id, ref, case when n > 2000 then 'biographical' when n > 1000 then 'work_context_only' else 'ambiguous' end as primary_verdict, 'communication' as primary_classification,
    case when n >= 400 then 'yes' else 'unclear' end as is_about_requester, case when n > 3000 then 1.0::double when n >= 400 then 0.25::double else 0.0::double end as confidence,
    'escalate' as recommended_action from (select *, length(text) as n from docs)""",
)
def context_coercion(spark, d):
    prompts = st.docs(spark, d).withColumnRenamed("text", "prompt")
    rows = scorers.chat(prompts, _reply).select("case_id", "ref", replies.context_row(F.col("reply"), F.col("reachable")).alias("r"))
    return rows.select("case_id", "ref", "r.primary_verdict", "r.primary_classification", "r.is_about_requester", "r.confidence", "r.recommended_action")


def _hash_vectors():
    """Stand-in embedder: letter frequencies."""

    def embed(texts: list[str]) -> list[list[float]]:
        return [[float(t.count(c)) + 1.0 for c in "aeiou"] for t in texts]

    return embed


@query(
    "embed_documents",
    with_("docs")
    + """select case_id, ref, round(sqrt(""" + " + ".join(f"power(length(text) - length(replace(text, '{c}', '')) + 1, 2)" for c in "aeiou") + """), 4) as norm from docs""",
)
def embed_documents(spark, d):
    out = scorers.embed(st.docs(spark, d), _hash_vectors)
    return out.select("case_id", "ref", F.round(stats.norm(F.col("embedding")), 4).alias("norm"))


@query(
    "leak_terms",
    with_("decisions")
    + """select case_id, ref, term, count(*) as n from (select case_id, ref, unnest([decision, reason_code]) as term from decisions where note <> '') group by 1, 2, 3""",
)
def leak_terms(spark, d):
    """Terms at the head of a reviewer's note, one row per term."""
    rows = st.decisions(spark, d).filter("note <> ''")
    note = F.concat(F.lit("LEAK_TERMS="), F.to_json(F.array("decision", "reason_code")), F.lit("\n"), "note")
    return (
        rows.select("case_id", "ref", F.explode(replies.leak_terms(note)).alias("term"))
        .groupBy("case_id", "ref", "term")
        .agg(F.count(F.lit(1)).alias("n"))
    )
