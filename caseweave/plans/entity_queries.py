"""Detection, tagging, flags, redaction, leaks, duplicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import spans, text as tx, vocab
from ..operators import dedupe, entities, latest, metrics, needles, redaction, review
from ..session import cut_lineage
from . import standins as st
from .registry import query
from .standins import with_

EMAIL = st.EMAIL_SQL
PHONE = vocab.PHONE_UK
NINO = vocab.NINO


@query(
    "entity_counts_by_source",
    with_("docs")
    + f"""select case_id, count(*) as documents, count(*) filter (where e + p + n > 0) as documents_with_entities,
    cast(sum(e + p + n) as bigint) as entity_count, cast(sum(e) as bigint) as emails, cast(sum(p) as bigint) as phones, cast(sum(n) as bigint) as ninos
    from (select case_id, len(regexp_extract_all(text, '{EMAIL}')) as e, len(regexp_extract_all(text, '{PHONE}')) as p,
    len(regexp_extract_all(text, '{NINO}')) as n from docs) group by case_id""",
)
def entity_counts_by_source(spark, d):
    return entities.contact_counts(st.docs(spark, d))


@query(
    "entity_spans",
    with_("docs")
    + f"""select case_id, ref, cast(list_sum(list_transform(gaps[1:i], lambda g: length(g))) + coalesce(list_sum(list_transform(hits[1:i-1], lambda h: length(h))), 0) as int) as start,
    cast(list_sum(list_transform(gaps[1:i], lambda g: length(g))) + list_sum(list_transform(hits[1:i], lambda h: length(h))) as int) as "end", hits[i] as text, type
    from (select case_id, ref, type, hits, gaps, unnest(range(1, len(hits) + 1)) as i from (
    select case_id, ref, type, regexp_extract_all(text, rx) as hits, regexp_split_to_array(text, rx) as gaps from docs,
    (values ('email', '{EMAIL}'), ('phone_uk', '{PHONE}'), ('nino', '{NINO}')) v(type, rx)))""",
)
def entity_spans(spark, d):
    return entities.contact_rows(st.docs(spark, d))


@query(
    "needle_hits",
    with_("docs")
    + f"""select case_id, lower(w) as needle, cast(sum((length(lower(text)) - length(replace(lower(text), lower(w), ''))) // length(w)) as bigint) as hits
    from (select case_id, ref, text, unnest(list_distinct(regexp_extract_all(text, '{st.WORD}'))) as w from docs) group by 1, 2""",
)
def needle_hits(spark, d):
    """Every occurrence, in any letter case, of the long words each document capitalises."""
    rows = st.read_by_model(spark, d).withColumn("low", spans.folded(F.col("text")))
    wanted = F.transform("found", lambda f: F.struct(f["text"].alias("value"), spans.folded(f["text"]).alias("low")))
    walked = needles.locate(rows.select("case_id", "found", "low"), "low", wanted)
    counted = F.zip_with("found", "starts", lambda f, at: F.struct(F.lower(f["text"]).alias("needle"), F.size(at).alias("n")))
    return walked.select("case_id", F.inline(counted)).groupBy("case_id", "needle").agg(F.sum("n").alias("hits"))


def _case_words(spark, d):
    """What is looked for in each case: the long words that its documents in English capitalise."""
    words = F.explode(F.regexp_extract_all("text", F.lit(st.WORD), F.lit(0)))
    return st.docs(spark, d).filter("lang = 'en'").select("case_id", words.alias("needle"))


@query(
    "case_needles",
    with_("docs")
    + f"""select case_id, ref, needle, cast(stop - length(needle) as int) as start, cast(stop as int) as "end" from (
    select case_id, ref, needle, i, last, sum(length(piece) + length(needle)) over (partition by ref, needle order by i) as stop from (
    select case_id, ref, needle, unnest(range(1, len(pieces) + 1)) as i, unnest(pieces) as piece, len(pieces) as last from (
    select case_id, ref, needle, string_split(low, needle) as pieces from (select case_id, ref, lower(text) as low from docs)
    join (select distinct case_id, lower(w) as needle from (select case_id, unnest(regexp_extract_all(text, '{st.WORD}')) as w from docs where lang = 'en')) n using (case_id)
    where contains(low, needle)))) where i < last""",
)
def case_needles(spark, d):
    """Every place in a case's documents, of whatever language, where one of the case's words stands."""
    return needles.locate_in_cases(st.docs(spark, d), _case_words(spark, d))


@query(
    "tag_build",
    with_("ent_spans")
    + """select case_id, ref, count(*) as entity_count, count(*) filter (redact = 'redact') as redact_count, count(*) filter (redact = 'flag') as flag_count,
    count(*) filter (cls = 'data_subject') as subject_count, sha256(string_agg(told, ',' order by told)) as spans_sha256
    from (select *, start || ':' || "end" || ':' || etype || ':' || cls || ':' || redact || ':' || etext as told from ent_spans) group by case_id, ref""",
)
def tag_build(spark, d):
    subject = F.size(F.filter("entities", lambda e: e["classification"] == "data_subject"))
    told = F.transform("entities", lambda e: F.concat_ws(
        ":", e["start"].cast("string"), e["end"].cast("string"), e["type"], e["classification"], e["redact"], e["text"]
    ))
    return (
        st.tags(spark, d)
        .filter("entity_count > 0")
        .select(
            "case_id", "ref",
            *[F.col(c).cast("bigint").alias(c) for c in ("entity_count", "redact_count", "flag_count")],
            subject.cast("bigint").alias("subject_count"),
            F.sha2(F.array_join(F.array_sort(told), ","), 256).alias("spans_sha256"),
        )
    )


@query(
    "subject_identifier_set",
    with_("subjects")
    + """select case_id, unnest(list_distinct(list_filter([lower(full_name), lower(alias), lower(email)], lambda x: x is not null))) as identifier from subjects""",
)
def subject_identifier_set(spark, d):
    ids = entities.subject_identifiers(st.subjects(spark, d))
    return ids.select("case_id", F.explode("subject_ids").alias("identifier"))


FLAGS = with_("ents")


@query(
    "flag_clusters",
    FLAGS
    + """select case_id, etext as text, cls as classification, cast(sum(n) as bigint) as instance_count, count(distinct ref) as distinct_docs
    from ents where redact = 'flag' group by 1, 2, 3""",
)
def flag_clusters(spark, d):
    return entities.flag_clusters(entities.entity_rows(st.tags(spark, d)))


@query(
    "flag_cluster_refs",
    FLAGS + "select distinct case_id, etext as text, cls as classification, ref from ents where redact = 'flag'",
)
def flag_cluster_refs(spark, d):
    return entities.flag_cluster_refs(entities.entity_rows(st.tags(spark, d)))


@query(
    "flag_snippets",
    with_("docs")
    + f"""select case_id, ref, type, hits[i] as value, text[greatest(s - 59, 1):s] as snippet_before, text[s + length(hits[i]) + 1:s + length(hits[i]) + 60] as snippet_after
    from (select *, cast(list_sum(list_transform(gaps[1:i], lambda g: length(g))) + coalesce(list_sum(list_transform(hits[1:i-1], lambda h: length(h))), 0) as bigint) as s
    from (select *, unnest(range(1, len(hits) + 1)) as i from (select case_id, ref, text, type, regexp_extract_all(text, rx) as hits, regexp_split_to_array(text, rx) as gaps
    from docs, (values ('email', '{EMAIL}'), ('phone_uk', '{PHONE}'), ('nino', '{NINO}')) v(type, rx))))""",
)
def flag_snippets(spark, d):
    """Sixty characters around every contact detail found, as shown to a reviewer of open flags."""
    docs = st.docs(spark, d)
    flags = entities.contact_rows(docs).withColumns({"redact": F.lit("flag"), "classification": F.lit("unknown")})
    rows = entities.flag_instances(flags, docs)
    return rows.select("case_id", "ref", "type", F.col("text").alias("value"), "snippet_before", "snippet_after")


@query(
    "pending_flags",
    with_("ents", "register")
    + """select r.case_id, coalesce(f, 0) as entity_flags, n as register_notes from
    (select case_id, count(*) filter (where contains(coalesce(notes, ''), 'flagged for review')) as n from register group by 1) r
    left join (select case_id, cast(coalesce(sum(n) filter (where redact = 'flag'), 0) as bigint) as f from ents group by 1) e using (case_id)""",
)
def pending_flags(spark, d):
    return entities.pending_flags(entities.entity_rows(st.tags(spark, d)), st.register(spark, d))


def _flag_decisions(rows):
    """A cluster decision for each flagged text, by its first letter."""
    clusters = entities.flag_clusters(rows)
    first = F.substring("text", 1, 1)
    return clusters.select(
        "case_id", "text", "classification",
        F.lit(1).cast("bigint").alias("seq"),
        F.lit("cluster").alias("scope"),
        F.when(first < "G", "redact").when(first < "P", "preserve").otherwise("escalate").alias("verdict"),
        F.lit(None).cast("string").alias("ref"),
        F.lit(None).cast("int").alias("start"),
        F.lit(None).cast("int").alias("end"),
    )


@query(
    "flag_resolution",
    FLAGS
    + """select case_id, state, cast(sum(n) as bigint) as n from (select case_id, n, case when redact <> 'flag' then redact when etext[1] < 'G' then 'redact'
    when etext[1] < 'P' then 'preserve' else 'flag' end as state from ents) group by 1, 2""",
)
def flag_resolution(spark, d):
    tagged = cut_lineage(entities.entity_rows(st.tags(spark, d)))
    rows = redaction.resolve_flags(tagged, _flag_decisions(tagged))
    return rows.groupBy("case_id", F.col("redact").alias("state")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "flag_resolution_bulk",
    FLAGS
    + """select case_id, case when redact = 'flag' then 'redact' else redact end as state, cast(sum(n) as bigint) as n from ents group by 1, 2""",
)
def flag_resolution_bulk(spark, d):
    rows = redaction.resolve_all_flags(entities.entity_rows(st.tags(spark, d)), "redact")
    return rows.groupBy("case_id", F.col("redact").alias("state")).agg(F.count(F.lit(1)).alias("n"))


def _contact_tags(spark, d):
    found = F.transform(
        spans.contact_spans(F.col("text")),
        lambda s: F.struct(
            s["start"].alias("start"), s["end"].alias("end"), s["text"].alias("text"), s["type"].alias("type"),
            F.lit("regex").alias("source"), F.lit("third_party").alias("classification"), F.lit("redact").alias("redact"),
        ),
    )
    return entities.with_counts(st.docs(spark, d).select("case_id", "ref", found.alias("entities")))


@query(
    "redact_contacts",
    with_("docs")
    + f"""select case_id, ref, length(x) as n_chars, sha256(x) as digest from (select case_id, ref, regexp_replace(text, '{EMAIL}', '[TP]', 'g') as x from docs)""",
)
def redact_contacts(spark, d):
    out = redaction.redact_text(st.docs(spark, d), redaction.overlay(_contact_tags(spark, d)))
    return out.select(
        "case_id", "ref", F.char_length("redacted").cast("bigint").alias("n_chars"), F.sha2("redacted", 256).alias("digest")
    )


@query("apply_redactions")
def apply_redactions(spark, d):
    """Full tags, overlapping spans included; the greedy choice has no plain SQL twin."""
    out = redaction.redact_text(st.docs(spark, d), redaction.overlay(st.tags(spark, d)))
    return out.select("case_id", "ref", F.char_length("redacted").alias("n_chars"), F.sha2("redacted", 256).alias("digest"))


@query(
    "redaction_badges",
    FLAGS
    + """select case_id, case when redact = 'flag' then 'NR' else case cls when 'data_subject' then 'DS' when 'third_party' then 'TP' when 'organisation' then 'CC' else 'NR' end end as code,
    cast(sum(n) as bigint) as n from ents group by 1, 2""",
)
def redaction_badges(spark, d):
    rows = redaction.overlay(st.tags(spark, d)).select("case_id", F.explode("overlay").alias("o"))
    return rows.groupBy("case_id", F.col("o.code").alias("code")).agg(F.count(F.lit(1)).alias("n"))


LEAK_RX = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"


@query(
    "leak_check",
    with_("docs")
    + f"""select case_id, ref, len(leaks) as n_leaks, case when len(leaks) > 0 then 'failed' else 'redacted' end as status from (
    select case_id, ref, list_filter(terms, lambda t: contains(lower(red), lower(t))) as leaks from (
    select case_id, ref, list_distinct(regexp_extract_all(text, '{st.WORD}')) as terms, regexp_replace(text, '{st.WORD}', '[TP]', 'g') as red from docs) where len(terms) > 0)""",
)
def leak_check(spark, d):
    """Words redacted where they are capitalised, and what other spellings leave behind."""
    docs = st.docs(spark, d)
    found = F.transform(
        spans.pattern_spans(F.col("text"), st.WORD, "word"),
        lambda s: F.struct(
            s["start"].alias("start"), s["end"].alias("end"), s["text"].alias("text"), s["type"].alias("type"),
            F.lit("regex").alias("source"), F.lit("third_party").alias("classification"), F.lit("redact").alias("redact"),
        ),
    )
    tags = docs.select("case_id", "ref", found.alias("entities")).filter(F.size("entities") > 0)
    checked = redaction.leak_check(redaction.redact_text(docs, redaction.overlay(tags)), tags)
    return checked.select("case_id", "ref", F.size("leaks").cast("bigint").alias("n_leaks"), "status")


@query(
    "leak_list",
    with_("register", "decisions")
    + f"""select r.case_id, r.ref, r.filename, len(w) as leaks_count, array_to_string(list_sort(w)[1:8], ',') as leaks_sample, coalesce(d.decision, 'pending') as decision
    from (select case_id, ref, filename, list_distinct(regexp_extract_all(text, '[A-Z][a-z]{{4,}}')) as w from register where status = 'failed') r
    left join (select ref, arg_max(decision, seq) as decision from decisions group by ref) d using (ref)""",
)
def leak_list(spark, d):
    """Failed redactions with the words that leaked, in the order a reviewer sees them."""
    reg = st.register(spark, d)
    words = F.array_sort(F.array_distinct(F.regexp_extract_all("text", F.lit("[A-Z][a-z]{4,}"), F.lit(0))))
    checks = reg.filter("status = 'failed'").select("case_id", "ref", words.alias("leaks"))
    no_tags = reg.select("case_id", "ref", F.lit(0).alias("entity_count"), F.lit(0).alias("redact_count"))
    dec = st.decisions(spark, d).drop("case_id").join(reg.select("case_id", "ref"), "ref")
    rows = redaction.leak_list(reg, checks, no_tags, dec)
    return rows.select(
        "case_id", "ref", "filename", F.col("leaks_count").cast("bigint").alias("leaks_count"), F.array_join("leaks_sample", ",").alias("leaks_sample"), "decision"
    )


@query(
    "redaction_plan",
    with_("synth", "docs")
    + f"""select s.case_id, s.ref, n as n_spans, case when n > 0 then 'third_party_data' else 'none' end as reason_code from synth s
    join (select case_id, ref, len(regexp_extract_all(text, '{EMAIL}')) as n from docs) using (case_id, ref) where scope_verdict = 'present'""",
)
def redaction_plan(spark, d):
    from .scope_queries import synthesised

    plan = redaction.redaction_plan(synthesised(spark, d), _contact_tags(spark, d))
    return plan.select("case_id", "ref", F.size("spans").cast("bigint").alias("n_spans"), "reason_code")


@query(
    "plan_without_output",
    with_("synth", "register")
    + """select case_id, ref from synth where scope_verdict = 'present' and ref not in (select ref from register where status in ('redacted', 'exported'))""",
)
def plan_without_output(spark, d):
    from .scope_queries import synthesised

    files = st.register(spark, d).filter("status in ('redacted', 'exported')")
    return redaction.plan_without_output(synthesised(spark, d).filter("scope_verdict = 'present'"), files)


@query("anonymise")
def anonymise(spark, d):
    """Text with one label per distinct name in a case in place of the name."""
    from ..functions import hashing

    tags = cut_lineage(st.tags(spark, d))
    names = entities.entity_rows(tags).select("case_id", F.lower("text").alias("name")).distinct()
    labels = names.withColumn("label", F.concat(F.lit("PERSON_C"), hashing.cluster_id(F.col("name"))))
    out = redaction.anonymise(st.docs(spark, d), tags, labels)
    return out.select("case_id", "ref", F.sha2("anonymised", 256).alias("digest"))


@query(
    "juror_disagreement",
    with_("docs")
    + """select case_id, ref, kind as disagreement_kind from (select case_id, ref, case when quality <> toxic then 'boolean' when lang in ('de', 'fr') then 'categories' end as kind
    from docs join labels using (doc_id)) where kind is not null""",
)
def juror_disagreement(spark, d):
    """Juror A follows `quality`, juror B `toxic`; they name categories by language."""
    lab = st.docs(spark, d).drop("text").join(st.table(spark, d, "labels"), "doc_id")

    def juror(name, flag, cats):
        return lab.select("case_id", "ref", F.lit(name).alias("juror"), (F.col(flag) == 1).alias("has_third_party_pii"), cats.alias("pii_categories"))

    mail, both = F.array(F.lit("email")), F.array(F.lit("phone"), F.lit("email"))
    rows = juror("A", "quality", mail).unionByName(juror("B", "toxic", F.when(F.col("lang").isin("de", "fr"), both).otherwise(mail)))
    return redaction.juror_disagreements(rows).select("case_id", "ref", "disagreement_kind")


@query(
    "findings_by_ref",
    with_("docs")
    + f"""select case_id, ref, count(*) as n_findings, string_agg(m, ',' order by m) as surfaces from (
    select case_id, ref, unnest(regexp_extract_all(text, '{EMAIL}')) as m from docs) group by 1, 2""",
)
def findings_by_ref(spark, d):
    rows = entities.contact_rows(st.docs(spark, d)).select(
        "case_id", "ref", F.lit(1).alias("stage"), F.col("text").alias("surface"), "type", F.lit("regex").alias("detector"), F.lit(1.0).alias("confidence")
    )
    out = entities.findings_by_ref(rows)
    return out.select("case_id", "ref", "n_findings", F.array_join(F.transform("entities", lambda e: e["surface"]), ",").alias("surfaces"))


# ---- duplicates ------------------------------------------------------------

DEDUPE = with_("ldocs") + (
    ", f as (select case_id, ref, text, basis as dedupe_basis, case when ref = min(ref) over w then 'canonical' else 'duplicate' end as dedupe_verdict, "
    "case when ref = min(ref) over w then count(*) over w else 0 end as copies from (select *, case when lang = 'en' then 'message_id' else 'sha256' end as basis, "
    "sha256(text) as k from ldocs) window w as (partition by case_id, basis, k)) "
)


def _findings(spark, d):
    docs = st.docs(spark, d, "lang")
    hashed = docs.select("case_id", "ref", F.sha2("text", 256).alias("hash"), F.when(F.col("lang") == "en", F.sha2("text", 256)).alias("message_id"))
    return dedupe.mark_duplicates(hashed, F.col("message_id"))


@query("dedupe_canonical", DEDUPE + "select case_id, ref, dedupe_verdict, dedupe_basis, copies from f")
def dedupe_canonical(spark, d):
    return _findings(spark, d).drop("dedupe_key")


@query(
    "dedupe_summary",
    DEDUPE
    + """select case_id, count(*) filter (where dedupe_verdict = 'canonical') as canonical, count(*) filter (where dedupe_verdict = 'duplicate') as duplicates,
    count(*) filter (where dedupe_verdict = 'duplicate' and dedupe_basis = 'message_id') as duplicates_message_id,
    count(*) filter (where dedupe_verdict = 'duplicate' and dedupe_basis = 'sha256') as duplicates_sha256,
    round(100.0::double * count(*) filter (where dedupe_verdict = 'duplicate') / count(*), 4) as pct_collapsed from f group by 1""",
)
def dedupe_summary(spark, d):
    return dedupe.dedupe_summary(_findings(spark, d))


@query(
    "dedupe_filter_status",
    DEDUPE
    + """select case_id, 'canonical_only' as mode, count(*) as input_count, count(*) filter (where dedupe_verdict = 'canonical') as canonical_count,
    count(*) filter (where dedupe_verdict = 'duplicate') as skipped, '' as warning,
    'canonical_only: ' || count(*) filter (where dedupe_verdict = 'canonical') || ' of ' || count(*) || ' refs to process' as summary from f group by 1""",
)
def dedupe_filter_status(spark, d):
    return dedupe.filter_status(st.docs(spark, d, "lang"), cut_lineage(_findings(spark, d)))


@query("canonical_documents", DEDUPE + "select case_id, ref, length(text) as n from f where dedupe_verdict = 'canonical'")
def canonical_documents(spark, d):
    docs = st.docs(spark, d, "lang").select("case_id", "ref", F.char_length("text").cast("bigint").alias("n"))
    return dedupe.keep_canonical(docs, cut_lineage(_findings(spark, d)))


@query(
    "hash_to_ref",
    with_("ldocs") + "select case_id, arg_max(ref, doc_id) as ref, 'canonical' as dedupe_verdict from ldocs group by case_id, sha256(text)",
)
def hash_to_ref(spark, d):
    """Findings keyed by content hash, translated to refs."""
    reg = st.docs(spark, d, "lang").select("case_id", "ref", F.sha2("text", 256).alias("hash"), F.col("doc_id").alias("seq"))
    findings = reg.select("case_id", F.col("hash").alias("doc_ref")).distinct().withColumn("dedupe_verdict", F.lit("canonical"))
    return dedupe.refs_by_hash(findings, reg).select("case_id", "ref", "dedupe_verdict")


# ---- inputs ----------------------------------------------------------------


@query(
    "missing_docs",
    with_("register", "decisions")
    + """select r.case_id, path, filename, '.' || ext as extension, coalesce(d.decision, 'pending') as decision, coalesce(d.reason_code, '') as reason_code, coalesce(d.ts, '') as decision_ts
    from register r left join (select ref, arg_max(decision, seq) as decision, arg_max(reason_code, seq) as reason_code, arg_max(ts, seq) as ts from decisions group by ref) d using (ref)
    where doc_id not in (select doc_id from labels)""",
)
def missing_docs(spark, d):
    """Input paths without a label stand for files that were not ingested."""
    reg = st.register(spark, d).select("case_id", "ref", "path", "doc_id")
    ingested = reg.join(st.table(spark, d, "labels"), "doc_id", "left_semi")
    dec = st.decisions(spark, d).drop("case_id").join(reg.select("case_id", "ref", "path"), "ref")
    return review.unextractable(reg, ingested, dec)


@query(
    "ingested_refs",
    with_("register") + "select case_id, path, ref, length(path) as n from register where doc_id in (select doc_id from labels)",
)
def ingested_refs(spark, d):
    from ..operators import scope

    reg = st.register(spark, d)
    items = reg.join(st.table(spark, d, "labels"), "doc_id", "left_semi").select("case_id", "path", F.char_length("path").cast("bigint").alias("n"))
    return scope.refs_of_paths(items, reg)


@query(
    "corpus_scale",
    with_("docs")
    + r"select case_id, count(*) as doc_count, cast(sum(len(regexp_extract_all(text, '[^\s\p{Z}]+'))) as bigint) as word_count from docs group by 1",
)
def corpus_scale(spark, d):
    return metrics.corpus_scale(st.docs(spark, d))


@query(
    "path_and_email_strip",
    with_("register")
    + f"""select case_id, ref, 'mail/' || filename as short_path, sha256(regexp_replace(text, '{LEAK_RX}', '<email-redacted>', 'g')) as digest from register""",
)
def path_and_email_strip(spark, d):
    return st.register(spark, d).select(
        "case_id", "ref", tx.short_path(F.col("path")).alias("short_path"), F.sha2(tx.hide_emails(F.col("text")), 256).alias("digest")
    )


# ---- decision logs ---------------------------------------------------------


@query(
    "latest_decision",
    with_("decisions")
    + """select case_id, ref, arg_max(decision, seq) as decision, arg_max(reason_code, seq) as reason_code, arg_max(ts, seq) as ts, max(seq) as seq, count(*) as n_rows
    from decisions group by 1, 2""",
)
def latest_decision(spark, d):
    return latest.latest_per_key(st.decisions(spark, d).drop("note"), ["case_id", "ref"])


@query(
    "first_decision",
    with_("decisions") + "select case_id, ref, arg_min(decision, seq) as decision, min(seq) as seq, count(*) as n_rows from decisions group by 1, 2",
)
def first_decision(spark, d):
    return latest.first_per_key(st.decisions(spark, d).select("case_id", "ref", "seq", "decision"), ["case_id", "ref"])


@query(
    "latest_row",
    with_("plog") + "select case_id, max(seq) as seq, arg_max(stage, seq) as stage, arg_max(outcome, seq) as outcome from plog group by 1",
)
def latest_row(spark, d):
    return latest.latest_row(st.pipeline_log(spark, d).select("case_id", "seq", "stage", "outcome"))


@query(
    "decision_counts",
    with_("decisions")
    + ", l as (select case_id, ref, arg_max(decision, seq) as decision from decisions group by 1, 2) select case_id, count(*) as total, "
    + ", ".join(f"count(*) filter (where decision = '{v}') as n_{v}" for v in vocab.QA_DECISIONS)
    + " from l group by 1",
)
def decision_counts(spark, d):
    last = latest.latest_per_key(st.decisions(spark, d).select("case_id", "ref", "seq", "decision"), ["case_id", "ref"])
    return metrics.decision_counts(last, vocab.QA_DECISIONS)


@query(
    "recent_kinds",
    with_("plog")
    + """select case_id, string_agg(stage, ',' order by seq desc) as recent from (select *, row_number() over (partition by case_id order by seq desc) as rn from plog) where rn <= 3 group by 1""",
)
def recent_kinds(spark, d):
    out = latest.recent_kinds(st.pipeline_log(spark, d))
    return out.select("case_id", F.array_join("recent", ",").alias("recent"))


@query(
    "sample_with_decisions",
    with_("docs", "decisions")
    + """select c.case_id, c.ref, coalesce(d.decision, 'pending') as decision, coalesce(reason_code, '') as reason_code from (select case_id, ref from docs where n_chars > 3000) c
    left join (select ref, arg_max(decision, seq) as decision, arg_max(reason_code, seq) as reason_code from decisions group by 1) d using (ref)""",
)
def sample_with_decisions(spark, d):
    docs = st.docs(spark, d).filter("n_chars > 3000").select("case_id", "ref")
    dec = st.decisions(spark, d).drop("case_id").join(docs, "ref")
    return latest.with_latest(docs, dec, ["case_id", "ref"]).select("case_id", "ref", "decision", "reason_code")
