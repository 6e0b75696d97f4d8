"""People register, samples, review queue, release."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import hashing, stats, vocab
from ..operators import entities, people, quality, review, sampling
from ..session import cut_lineage
from . import standins as st
from .registry import query
from .standins import with_

SUBJ = "coalesce(is_data_subject, false)"

#: Merges as they apply, one decision after the other: `gone` holds the clusters of a case that are merged away.
FOLD = with_("people", "people_decisions").replace("with ", "with recursive ", 1) + (
    ", m as (select case_id, cluster_id, target_id, seq, row_number() over (partition by case_id order by seq) as i from people_decisions where action = 'merge_with' and target_id <> cluster_id), "
    "fold as (select distinct case_id, cast(0 as bigint) as i, []::varchar[] as gone, null::varchar as src, null::varchar as dst, null::bigint as seq from m union all "
    "select f.case_id, m.i, case when list_has_any(gone, [m.cluster_id, m.target_id]) then gone else list_append(gone, m.cluster_id) end, "
    "case when not list_has_any(gone, [m.cluster_id, m.target_id]) then m.cluster_id end, m.target_id, m.seq from fold f join m on m.case_id = f.case_id and m.i = f.i + 1), "
    "v as (select case_id, src, dst, seq from fold where src is not null), "
    "walk as (select case_id, src as cluster_id, dst as target from v union all select w.case_id, w.cluster_id, v.dst from walk w join v on v.case_id = w.case_id and v.src = w.target), "
    "z as (select * from walk w where not exists (select 1 from v where v.case_id = w.case_id and v.src = w.target)), "
    "p as (select case_id, sha1(canonical_name)[1:16] as cluster_id, canonical_name, mention_count, custkey, has_email, is_data_subject from people), "
    "l as (select case_id, cluster_id, arg_max(action, seq) as action, arg_max(note, seq) as note from people_decisions d where action <> 'merge_with' "
    "and not exists (select 1 from v where v.case_id = d.case_id and v.src = d.cluster_id) group by 1, 2) "
)


@query(
    "people_top_n",
    with_("people")
    + """select case_id, canonical_name, rank, round(score, 4) as ranking_score from (select *, row_number() over (partition by case_id order by score desc, canonical_name) as rank from (
    select *, cast(mention_count as double) * cast(distinct_doc_count as double) * (1 - is_subject_confidence) as score from people where not is_data_subject)) where rank <= 50""",
)
def people_top_n(spark, d):
    return people.top_people(st.people(spark, d)).select("case_id", "canonical_name", "rank", F.round("ranking_score", 4).alias("ranking_score"))


@query(
    "referent_candidates",
    with_("people") + "select case_id, canonical_name, subject_centricity_score from people where not is_data_subject and subject_centricity_score > 0.7",
)
def referent_candidates(spark, d):
    return people.referent_candidates(st.people(spark, d)).select("case_id", "canonical_name", "subject_centricity_score")


@query(
    "dual_juror",
    with_("people")
    + """, t as (select case_id, is_subject_confidence, row_number() over (partition by case_id order by cast(mention_count as double) * cast(distinct_doc_count as double) * (1 - is_subject_confidence) desc, canonical_name) as rank
    from people where not is_data_subject), u as (select case_id, avg(case when is_subject_confidence < 0.85 then 1.0::double else 0.0::double end) as share from t where rank <= 50 group by 1)
    select case_id, round(share, 6) as unsure_share, share >= 0.2 as dual from u""",
)
def dual_juror(spark, d):
    rows = st.people(spark, d)
    cases = rows.select("case_id").distinct().withColumns({"dual_juror": F.lit(False), "vulnerable": F.lit(False)})
    return people.dual_juror(rows, cases).withColumn("unsure_share", F.round("unsure_share", 6))


@query(
    "people_coverage",
    FOLD
    + """select p.case_id, count(*) as persons, cast(sum(case when has_email then 1 else 0 end) as bigint) as emails, count(*) as phones, count(*) filter (where is_data_subject) as subject_clusters,
    count(*) filter (where not is_data_subject) as third_party, count(*) filter (where action = 'accept_as_third_party') as denylist_redact, count(*) filter (where action = 'preserve') as denylist_preserve, 'passed' as gate
    from people p left join l on l.case_id = p.case_id and l.cluster_id = sha1(canonical_name)[1:16] group by 1""",
)
def people_coverage(spark, d):
    rows = people.with_ids(st.people(spark, d))
    return people.people_coverage(rows, people.decided_denylist(rows, st.people_decisions(spark, d)))


@query(
    "register_sufficiency",
    with_("people", "register")
    + """select r.case_id, bool_or(mailbox_owner_email is not null or ext = 'eml') as communicants, cast(0 as bigint) as third_party_clusters, cast(0 as bigint) as subject_clusters,
    case when bool_or(mailbox_owner_email is not null or ext = 'eml') then 'fail' else 'pass' end as gate from register r group by 1""",
)
def register_sufficiency(spark, d):
    """No cluster belongs to a document case here, so every case with mail must fail."""
    return people.register_sufficiency(st.people(spark, d), st.register(spark, d))


@query(
    "cluster_metrics",
    with_("mentions")
    + """select case_id, cluster, count(*) as mention_count, count(distinct ref) as distinct_doc_count, round(min(confidence), 6) as confidence_score, round(max(is_subject_confidence), 6) as is_subject_confidence
    from mentions group by 1, 2""",
)
def cluster_metrics(spark, d):
    out = people.cluster_metrics(st.mentions(spark, d))
    return out.withColumns({c: F.round(c, 6) for c in ("confidence_score", "is_subject_confidence")})


QUALITY = "case when l_quantity < 11 then 'low' when l_quantity < 21 then 'unknown' when l_quantity < 31 then 'medium' when l_quantity < 41 then 'high' else 'ocr_failure' end"


@query(
    "quality_mode",
    with_("mentions")
    + f""", q as (select case_id, cluster, {QUALITY} as tq, count(*) as n from mentions group by 1, 2, 3)
    select case_id, cluster, tq as text_quality_summary from (select *, row_number() over (partition by case_id, cluster order by n desc, list_position(['ocr_failure', 'unknown', 'low', 'medium', 'high'], tq)) as rn from q) where rn = 1""",
)
def quality_mode(spark, d):
    q = F.col("l_quantity")
    band = F.when(q < 11, "low").when(q < 21, "unknown").when(q < 31, "medium").when(q < 41, "high").otherwise("ocr_failure")
    return people.quality_mode(st.mentions(spark, d).withColumn("text_quality", band), ["case_id", "cluster"])


@query(
    "cluster_ids",
    with_("people") + "select case_id, canonical_name, sha1(canonical_name)[1:16] as cluster_id from people",
)
def cluster_ids(spark, d):
    return people.with_ids(st.people(spark, d)).select("case_id", "canonical_name", "cluster_id")


@query(
    "merged_clusters",
    FOLD
    + """, q as (select p.case_id, coalesce(z.target, p.cluster_id) as cluster_id, p.mention_count, p.custkey from p left join z using (case_id, cluster_id))
    select q.case_id, q.cluster_id, cast(sum(mention_count) as bigint) as mention_count, count(*) as merged_clusters, coalesce(any_value(dd), 0) as distinct_doc_count
    from q left join (select case_id, cluster_id, count(distinct date_trunc('month', o_orderdate)) as dd from q join orders on o_custkey = custkey group by 1, 2) r on r.case_id = q.case_id and r.cluster_id = q.cluster_id group by 1, 2""",
)
def merged_clusters(spark, d):
    rows = people.with_ids(st.people(spark, d))
    months = st.table(spark, d, "orders").select("o_custkey", F.date_format("o_orderdate", "yyyy-MM").alias("value")).distinct()
    members = rows.join(months, F.col("custkey") == F.col("o_custkey")).select("case_id", "cluster_id", F.lit("source_ref").alias("kind"), "value")
    targets = people.merge_targets(st.people_decisions(spark, d), rows)
    return people.merged_counts(rows, members, targets)


@query(
    "denylist",
    FOLD
    + """select p.case_id, cluster_id, canonical_name, action = 'accept_as_third_party' as redact, note as operator_note from l join p using (case_id, cluster_id)
    where action in ('accept_as_third_party', 'preserve')""",
)
def denylist(spark, d):
    return people.decided_denylist(people.with_ids(st.people(spark, d)), st.people_decisions(spark, d))


@query(
    "subject_aliases",
    FOLD
    + """, a as (select d.case_id, d.cluster_id, max(d.seq) as before from people_decisions d left join v on v.case_id = d.case_id and v.src = d.cluster_id
    where action = 'mark_subject_alias' and (v.seq is null or d.seq < v.seq) group by 1, 2),
    under as (select case_id, cluster_id, before from a union select v.case_id, v.src, v.seq from under u join v on v.case_id = u.case_id and v.dst = u.cluster_id and v.seq < u.before),
    n as (select * from p semi join under using (case_id, cluster_id)), s as (select case_id, min(canonical_name) as own from p where is_data_subject group by 1)
    select case_id, 'alias' as kind, canonical_name as value from p semi join a using (case_id, cluster_id) anti join s on s.case_id = p.case_id and own = canonical_name
    union select case_id, 'phone', '020' || custkey from n union select case_id, 'email', lower(canonical_name) || '@example.com' from n anti join s on s.case_id = n.case_id and own = canonical_name where has_email""",
)
def subject_aliases(spark, d):
    rows = people.with_ids(st.people(spark, d))
    members = rows.select("case_id", "cluster_id", F.lit("email").alias("kind"), F.explode("emails").alias("value")).unionByName(
        rows.select("case_id", "cluster_id", F.lit("phone").alias("kind"), F.explode("phones").alias("value"))
    )
    subjects = rows.filter("is_data_subject").groupBy("case_id").agg(F.min("canonical_name").alias("full_name"))
    subjects = subjects.withColumn("email", F.concat(F.lower("full_name"), F.lit("@example.com")))
    return people.subject_aliases(rows, members, st.people_decisions(spark, d), subjects)


def _mail(spark, d):
    """Documents headed by mail lines made of the addresses and words they hold."""
    docs = st.docs(spark, d)
    sender = F.concat(F.regexp_extract("text", st.WORD, 0), F.lit(" <"), F.col("case_id"), F.lit("@example.com>"))
    head = F.concat(F.lit("From: "), sender, F.lit("\nTo: "), "ref", F.lit("@example.org, \"Desk\" <desk@example.org>\nSubject: x\n\n"))
    return docs.withColumn("text", F.concat(head, "text"))


@query(
    "header_people",
    with_("docs")
    + f"""select case_id, ref, 'from' as header, case_id || '@example.com' as email, regexp_extract(text, '{st.WORD}', 0) as display_name from docs
    union all select case_id, ref, 'to', ref || '@example.org', '' from docs union all select case_id, ref, 'to', 'desk@example.org', 'Desk' from docs""",
)
def header_people(spark, d):
    return people.header_people(_mail(spark, d)).select("case_id", "ref", "header", "email", "display_name")


@query(
    "signature_people",
    with_("docs")
    + f"""select case_id, ref, 'Sam ' || w as display_name, 'anchored' as origin, 0.9::double as confidence from (select case_id, ref, regexp_extract(text, '{st.WORD}', 0) as w from docs) where w <> ''
    union all select case_id, ref, 'Kim ' || w, 'last_lines', 0.5::double from (select case_id, ref, regexp_extract(text, '{st.WORD}', 0) as w from docs) where w <> ''
    union all select case_id, ref, 'desk of ' || w, 'underscore', 0.4::double from (select case_id, ref, regexp_extract(text, '{st.WORD}', 0) as w from docs) where w <> ''""",
)
def signature_people(spark, d):
    """Documents closed by a signature block made of their own first long word."""
    w = F.regexp_extract("text", st.WORD, 0)
    block = F.concat(F.lit("\n\nSigned by: Sam "), w, F.lit("\n______\ndesk of "), w, F.lit("\nKim "), w, F.lit("\nSam "), w)
    docs = st.docs(spark, d).filter(w != "")
    return people.signature_people(docs.withColumn("text", F.concat("text", block)))


@query(
    "signature_candidates",
    with_("docs")
    + rf"""select case_id, ref, type, text, 'new_candidate' as outcome from (select case_id, ref, 'title_caps' as type, unnest(regexp_extract_all(text, '{vocab.TITLE_CAPS}')) as text from docs
    union all select case_id, ref, 'phone_label', unnest(regexp_extract_all(text, '(?i){vocab.PHONE_LABEL}')) from docs)
    where type = 'phone_label' or regexp_replace(text, '\s+', ' ', 'g') not in ({", ".join(f"'{t}'" for t in vocab.TITLE_ALLOWED)})""",
)
def signature_candidates(spark, d):
    docs = st.docs(spark, d)
    nobody = docs.filter(F.lit(False)).select(
        "case_id", "ref", F.lit("c").alias("cluster_id"), F.lit(0).alias("start"), F.lit(0).alias("end")
    )
    return people.signature_candidates(docs, nobody).select("case_id", "ref", "type", "text", "outcome")


@query("signature_attachment")
def signature_attachment(spark, d):
    """Capitalised titles and phone labels tied to the nearest address in the same document."""
    docs = st.docs(spark, d)
    known = entities.contact_rows(docs).select("case_id", "ref", F.lower("text").alias("cluster_id"), "start", "end")
    return people.signature_candidates(docs, known)


@query(
    "source_strategy",
    with_("register")
    + """select case_id, case when e > 0 then case when e >= o then 'exchange_nested' else 'sharepoint' end when o > 0 then 'sharepoint' else 'raw_dump' end as name,
    round(greatest(e, o), 6) as confidence from (select case_id, count(*) filter (where ext = 'eml') / count(*)::double as e, count(*) filter (where ext in ('docx', 'pdf')) / count(*)::double as o from register group by 1)""",
)
def source_strategy(spark, d):
    out = people.choose_strategy(people.strategy_candidates(st.register(spark, d)))
    return out.select("case_id", "name", F.round("confidence", 6).alias("confidence"))


@query(
    "header_proximity",
    with_("docs")
    + f"""select case_id, w as cluster, 1.0::double as header_share from (select distinct case_id, regexp_extract(text, '{st.WORD}', 0) as w from docs) where w <> ''""",
)
def header_proximity(spark, d):
    """Senders stand next to the recipients' line in every mail, so each is close to the subject."""
    rows = people.header_people(_mail(spark, d))
    named = rows.filter("header = 'from' and display_name <> ''").select("case_id", F.col("display_name").alias("cluster"), "ref", "line_no")
    subject = rows.filter("email = 'desk@example.org'").select("case_id", "ref", "line_no")
    return people.header_proximity(named, subject)


def _uuid5_sql(ns: str, name: str) -> str:
    h = f"sha1(from_hex(replace({ns}, '-', '')) || encode({name}))"
    variant = f"lower(substr('89ab', (strpos('0123456789abcdef', substr({h}, 17, 1)) - 1) % 4 + 1, 1))"
    return f"substr({h}, 1, 8) || '-' || substr({h}, 9, 4) || '-5' || substr({h}, 14, 3) || '-' || {variant} || substr({h}, 18, 3) || '-' || substr({h}, 21, 12)"


@query(
    "correlation_ids",
    with_("docs")
    + f"select case_id, ref, {_uuid5_sql('cns', chr(39) + 'raw_dump:' + chr(39) + ' || ref')} as correlation_id from (select case_id, ref, {_uuid5_sql(chr(39) + '6ba7b811-9dad-11d1-80b4-00c04fd430c8' + chr(39), 'case_id')} as cns from docs)",
)
def correlation_ids(spark, d):
    """Name-based ids of each document under its strategy."""
    ns = "6ba7b811-9dad-11d1-80b4-00c04fd430c8"
    return st.docs(spark, d).select("case_id", "ref", hashing.correlation_id(ns, F.col("case_id"), F.lit("raw_dump"), F.col("ref")).alias("correlation_id"))


def _person_mentions(spark, d):
    """Mentions with names, addresses and numbers: the long words and addresses of documents."""
    docs = st.docs(spark, d, "lang")
    words = F.array_distinct(F.regexp_extract_all("text", F.lit(st.WORD), F.lit(0)))
    mail = F.nullif(F.regexp_extract("text", vocab.EMAIL, 0), F.lit(""))
    rows = docs.select("case_id", "ref", F.posexplode(words).alias("pos", "name"), mail.alias("mail"))
    return rows.select(
        "case_id",
        F.concat_ws("#", "ref", F.col("pos").cast("string")).alias("mention_id"),
        "name",
        F.when(F.col("pos") == 0, F.col("mail")).alias("email"),
        F.lit(None).cast("string").alias("phone"),
    )


MENTIONS = with_("ldocs") + (
    f", l as (select case_id, ref, regexp_extract(text, '{st.EMAIL_SQL}', 0) as mail, regexp_extract_all(text, '{st.WORD}') as w from ldocs), "
    "u as (select case_id, ref, mail, list_filter(w, lambda x, i: list_position(w, x) = i) as w from l), "
    "m as (select case_id, ref || '#' || (i - 1) as mention_id, w[i] as value, lower(w[i]) as name, case when i = 1 then nullif(mail, '') end as mail from (select *, unnest(range(1, len(w) + 1)) as i from u)), "
    "g as (select case_id, name, list_distinct(list_transform(range(1, length(name) + 2), lambda i: ('  ' || name || ' ')[i:i + 2])) as g from (select distinct case_id, name from m)) "
)


@query(
    "alias_clusters",
    MENTIONS.replace("with docs", "with recursive docs", 1).replace("with ldocs", "with recursive ldocs", 1)
    + """, e as (select a.case_id, a.name as x, b.name as y from g a join g b on a.case_id = b.case_id and a.name <> b.name where len(list_intersect(a.g, b.g)) / sqrt(len(a.g) * len(b.g)) >= 0.85 - 1e-12
    union select a.case_id, a.name, b.name from m a join m b on a.case_id = b.case_id and lower(a.mail) = lower(b.mail)),
    r as (select case_id, name as x, name as y from g union select r.case_id, r.x, e.y from r join e on r.case_id = e.case_id and r.y = e.x),
    k as (select case_id, x as name, min(y) as root from r group by 1, 2) select case_id, mention_id, 'name:' || root as cluster from m join k using (case_id, name)""",
)
def alias_clusters(spark, d):
    """Persons behind mentions: same address, same or similar name."""
    return people.alias_clusters(cut_lineage(_person_mentions(spark, d)))


@query(
    "similar_names",
    with_("ldocs")
    + f""", n as (select distinct case_id, lower(w) as name from (select case_id, unnest(regexp_extract_all(text, '{st.WORD}')) as w from ldocs)),
    g as (select case_id, name, list_distinct(list_transform(range(1, length(name) + 2), lambda i: ('  ' || name || ' ')[i:i + 2])) as g from n)
    select a.case_id, a.name as name_a, b.name as name_b, round(len(list_intersect(a.g, b.g)) / sqrt(len(a.g) * len(b.g)), 6) as similarity from g a join g b on a.case_id = b.case_id and a.name < b.name
    where len(list_intersect(a.g, b.g)) / sqrt(len(a.g) * len(b.g)) >= 0.7 - 1e-12""",
)
def similar_names(spark, d):
    names = _person_mentions(spark, d).select("case_id", F.lower("name").alias("name")).distinct()
    return people.similar_names(cut_lineage(names), 0.7).withColumn("similarity", F.round("similarity", 6))


@query(
    "denylist_violations",
    """with e as (select 'c' || label as case_id, 'vec-' || vec_id as name, vec_id, cast(embedding as double[]) as v from embeddings),
    q as (select case_id, list_slice(list(v order by vec_id), 1, 3) as vs from e group by 1)
    select case_id, name as canonical_name, round(s, 6) as max_similarity from (select e.case_id, name, list_max(list_transform(vs, lambda x: list_cosine_similarity(v, x))) as s from e join q using (case_id)) where s > 0.4""",
)
def denylist_violations(spark, d):
    """Entries close to one of the first three vectors of their own case."""
    from pyspark.sql import Window

    e = st.table(spark, d, "embeddings").select(
        F.concat(F.lit("c"), "label").alias("case_id"), F.concat(F.lit("vec-"), "vec_id").alias("canonical_name"), "vec_id", F.col("embedding").alias("vector")
    )
    first = Window.partitionBy("case_id").orderBy("vec_id")
    subject = (
        e.withColumn("rn", F.row_number().over(first)).filter("rn <= 3").groupBy("case_id").agg(F.collect_list("vector").alias("vectors"))
    )
    return people.denylist_violations(e, subject, 0.4).withColumn("max_similarity", F.round("max_similarity", 6))


@query(
    "denylist_hits",
    MENTIONS
    + """, d as (select distinct case_id, name from m where length(value) = 12), f as (select distinct a.case_id, a.name from g a join d using (case_id) join g b on b.case_id = d.case_id and b.name = d.name
    where len(list_intersect(a.g, b.g)) / sqrt(len(a.g) * len(b.g)) >= 0.8 - 1e-12)
    select case_id, mention_id as ref, 'name' as kind, value, case when name in (select name from d where d.case_id = m.case_id) then 'exact' else 'fuzzy' end as match from m join f using (case_id, name)
    union all select case_id, mention_id, 'email', mail, 'exact' from m where mail is not null""",
)
def denylist_hits(spark, d):
    """Addresses and names of documents against a denylist of addresses and the shorter names."""
    m = cut_lineage(_person_mentions(spark, d))
    tokens = m.select("case_id", F.col("mention_id").alias("ref"), F.lit("name").alias("kind"), F.col("name").alias("value")).unionByName(
        m.filter("email is not null").select("case_id", F.col("mention_id").alias("ref"), F.lit("email").alias("kind"), F.col("email").alias("value"))
    )
    deny = tokens.filter("kind = 'email' or length(value) = 12").select("case_id", "kind", "value", F.lit(True).alias("redact"))
    return people.denylist_hits(tokens, deny, 0.8)


# ---- samples ---------------------------------------------------------------

COUNTS = with_("docs") + ", c as (select case_id, ref, len(regexp_extract_all(text, '[A-Z][a-z]{9,}')) as n, n_chars from docs) "


def _counted(spark, d):
    """Entity counts per document, written once: ranking reads them more than once."""
    n = F.size(F.regexp_extract_all("text", F.lit(st.WORD), F.lit(0)))
    return cut_lineage(st.docs(spark, d).select("case_id", "ref", n.alias("entity_count"), "n_chars"))


@query(
    "qa_sample",
    COUNTS
    + """, r as (select *, sha256('42|' || case_id || '|' || ref) as h, count(*) over (partition by case_id) as t from c),
    k as (select *, row_number() over (partition by case_id order by n desc, h[1:3], h, ref) as rk from r),
    b as (select *, case when t <= 30 then 'random' when rk <= 10 then 'high' when rk - 11 >= greatest(0, (t - 10) // 2 - 5) and rk - 11 < greatest(0, (t - 10) // 2 - 5) + 10 then 'medium' end as bucket from k),
    z as (select *, row_number() over (partition by case_id, bucket order by h, ref) as zz from b)
    select case_id, ref, coalesce(bucket, 'random') as bucket, n as entity_count from z where bucket is not null or zz <= 10""",
)
def qa_sample(spark, d):
    return sampling.qa_sample(_counted(spark, d)).withColumn("entity_count", F.col("entity_count").cast("bigint"))


@query(
    "calibration_sample",
    with_("verdicts", "rechecks")
    + """, s as (select 'all' as case_id, v.ref, case when primary_verdict = 'work_context_only' and recheck_verdict = 'reclassify_to_biographical' then 'disputed_recheck_says_bio'
    when primary_verdict = 'work_context_only' and recheck_verdict = 'confirmed_work_context_only' then 'agreed_work_context_only'
    when recheck_verdict = 'reclassify_to_ambiguous' then 'recheck_ambiguous' when primary_verdict = 'biographical' then 'originally_biographical' end as stratum from verdicts v left join rechecks r using (case_id, ref))
    select ref, stratum, rank from (select *, row_number() over (partition by stratum order by sha256('cal|' || case_id || '|' || ref), ref) as rank from s where stratum is not null)
    where rank <= case when stratum in ('disputed_recheck_says_bio', 'agreed_work_context_only') then 10 else 5 end""",
)
def calibration_sample(spark, d):
    from ..operators import scope

    strata = scope.verdict_strata(st.verdicts(spark, d), st.rechecks(spark, d), st.register(spark, d))
    return sampling.calibration_sample(strata.withColumn("case_id", F.lit("all"))).select("ref", "stratum", "rank")


@query(
    "walkthrough_sample",
    with_("register")
    + """, e as (select case_id, ref, count(*) over (partition by case_id) as eligible_pool_size, row_number() over (partition by case_id order by sha256('0|' || case_id || '|' || ref), ref) as rn from register where status in ('redacted', 'exported'))
    select case_id, ref, rn - 1 as position, eligible_pool_size from e where rn <= 20""",
)
def walkthrough_sample(spark, d):
    return sampling.walkthrough_sample(st.register(spark, d), 20).select("case_id", "ref", F.col("position").cast("bigint").alias("position"), "eligible_pool_size")


@query(
    "walkthrough_progress",
    with_("register", "decisions")
    + """, e as (select case_id, ref, row_number() over (partition by case_id order by sha256('0|' || case_id || '|' || ref), ref) as rn from register where status in ('redacted', 'exported')),
    l as (select ref, arg_max(decision, seq) as decision from decisions group by 1), j as (select e.case_id, rn - 1 as p, decision from e left join l using (ref) where rn <= 20)
    select case_id, count(*) as total, count(*) filter (where decision = 'approve') as approved, count(*) filter (where decision <> 'approve') as declined, count(*) filter (where decision is null) as pending,
    min(p) filter (where decision is null) as next_pending, bool_and(decision is not null and decision <> 'pending') as complete from j group by 1""",
)
def walkthrough_progress(spark, d):
    sample = sampling.walkthrough_sample(st.register(spark, d), 20)
    dec = st.decisions(spark, d).drop("case_id").join(st.docs(spark, d).select("case_id", "ref"), "ref")
    return sampling.sample_progress(sample, dec).withColumn("next_pending", F.col("next_pending").cast("bigint"))


def _rate_sql() -> str:
    return "case " + " ".join(f"when band = '{b}' and tq = '{q}' then {r}::double" for b, q, r in vocab.JURY_RATES) + f" else {vocab.JURY_RATE_DEFAULT}::double end"


JURY = with_("register") + (
    ", c as (select case_id, ref, text_quality as tq, len(regexp_extract_all(text, '[A-Z][a-z]{9,}')) as n from register), "
    "b as (select *, case when n < 1 then 'very_low_ner' when n < 5 then 'low_ner' when n < 20 then 'med_ner' else 'high_ner' end as band from c), "
    f"k as (select *, {_rate_sql()} as rate, count(*) over w as cell, row_number() over (w order by sha256('jury|' || case_id || '|' || ref), ref) as rk from b where tq <> 'ocr_failure' window w as (partition by case_id, band, tq)), "
    "m as (select *, rk <= ceil(round(rate * cell, 6)) as sel from k) "
)


def _jury_docs(spark, d):
    n = F.size(F.regexp_extract_all("text", F.lit(st.WORD), F.lit(0)))
    return cut_lineage(st.register(spark, d).select("case_id", "ref", "text_quality", n.alias("entity_count")))


@query(
    "jury_sample",
    JURY
    + """select case_id, ref, band, tq as text_quality, 'jury' as queue from m where sel union all select case_id, ref, band, tq, 'manual' from b where tq = 'ocr_failure'
    union all select case_id, ref, band, tq, 'jury_topup' from (select m.*, g.got, row_number() over (partition by m.case_id order by sha256('jury|' || m.case_id || '|' || ref), ref) as rn
    from m join (select case_id, count(*) filter (where sel) as got from m group by 1) g using (case_id) where not sel) where rn <= 30 - got""",
)
def jury_sample(spark, d):
    return sampling.jury_sample(_jury_docs(spark, d), min_floor=30)


@query(
    "jury_spot_check",
    JURY.replace(_rate_sql(), "0.05::double") + "select case_id, ref, case when tq = 'ocr_failure' then 'manual' else 'jury' end as queue from (select case_id, ref, tq from m where sel union all select case_id, ref, tq from b where tq = 'ocr_failure')",
)
def jury_spot_check(spark, d):
    return sampling.jury_sample(_jury_docs(spark, d), mode="spot_check").select("case_id", "ref", "queue")


# ---- review queue ----------------------------------------------------------

SEV = {"1-URGENT": "CRITICAL", "2-HIGH": "HIGH", "3-MEDIUM": "MEDIUM", "4-NOT SPECIFIED": "UNKNOWN", "5-LOW": "LOW"}
STAGES = {"F": "closed", "O": "redaction_running", "P": "scope_check_running"}


def _release_verdicts(spark, d):
    """A release verdict per order with one issue each; the case is the customer's market segment and status."""
    c = st.table(spark, d, "customer").select("c_custkey", "c_mktsegment")
    o = st.table(spark, d, "orders").join(c, F.col("o_custkey") == F.col("c_custkey"))
    sev = stats.lookup(SEV, F.col("o_orderpriority"))
    issue = lambda n, s: F.struct(F.concat(F.lit(n + "-"), F.col("o_orderkey")).alias("issue_id"), F.col("o_orderpriority").alias("issue"), s.alias("severity"))
    decision = F.when(F.col("o_totalprice") > 300000, "REJECT").when(F.col("o_totalprice") > 150000, "APPROVE_WITH_CONDITIONS").otherwise("APPROVE_FOR_HUMAN_SIGNOFF")
    return o.select(
        F.concat(F.lit("k"), "o_custkey").alias("case_id"),
        F.col("o_orderkey").alias("seq"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("ts"),
        decision.alias("decision"),
        F.array(issue("a", sev), issue("b", F.lit("HIGH"))).alias("blocking_issues"),
        "o_orderstatus", "o_orderdate", "o_totalprice",
    )


def _resolved(spark, d):
    rows = _release_verdicts(spark, d).filter("o_orderstatus = 'F'")
    return rows.select("case_id", F.concat(F.lit("b-"), "seq").alias("issue_id"))


_SEV_SQL = "case o_orderpriority when '1-URGENT' then 'CRITICAL' when '2-HIGH' then 'HIGH' when '3-MEDIUM' then 'MEDIUM' when '5-LOW' then 'LOW' else 'UNKNOWN' end"
LAST_ORDER = (
    f"with o as (select 'k' || o_custkey as case_id, *, {_SEV_SQL} as sev from orders), "
    "l as (select case_id, max(o_orderkey) as seq, arg_max(sev, o_orderkey) as sev, arg_max(o_orderstatus, o_orderkey) as os, arg_max(o_orderpriority, o_orderkey) as prio, "
    "arg_max(o_orderdate, o_orderkey) as od, arg_max(o_totalprice, o_orderkey) as tp from o group by 1), "
    "b as (select case_id, 'a-' || seq as issue_id, prio as issue, sev as severity, od from l union all select case_id, 'b-' || seq, prio, 'HIGH', od from l where os <> 'F') "
)


@query("open_blockers", LAST_ORDER + "select case_id, issue_id, severity from b")
def open_blockers(spark, d):
    return review.open_blockers(_release_verdicts(spark, d), _resolved(spark, d)).select("case_id", "issue_id", "severity")


@query(
    "blocker_summary",
    LAST_ORDER
    + """select l.case_id, cast(2 as bigint) as total, count(*) as open, count(*) filter (where severity = 'CRITICAL') as open_critical, count(*) filter (where severity = 'HIGH') as open_high from l join b using (case_id) group by 1""",
)
def blocker_summary(spark, d):
    out = review.blocker_summary(_release_verdicts(spark, d), _resolved(spark, d))
    return out.withColumn("total", F.col("total").cast("bigint"))


def _queue(spark, d):
    v = _release_verdicts(spark, d)
    asof = st.asof()
    blockers = review.open_blockers(v, _resolved(spark, d))
    failed = v.select("case_id", F.concat(F.lit("doc-"), "seq").alias("ref"), F.lit(None).cast("string").alias("filename"), F.when(F.col("o_totalprice") > 400000, "failed").otherwise("redacted").alias("status"))
    leak_dec = v.filter("o_orderstatus = 'P'").select("case_id", F.concat(F.lit("doc-"), "seq").alias("ref"), F.lit("accept_exclude").alias("decision"))
    missing = v.filter("o_totalprice < 20000").select("case_id", F.concat(F.lit("mail/in-"), "seq", F.lit(".eml")).alias("path"))
    none = missing.filter(F.lit(False)).withColumn("decision", F.lit("accept"))
    items = review.queue_items(blockers, failed, leak_dec, missing, none, asof)
    last = v.groupBy("case_id").agg(F.max_by(F.struct("o_orderstatus", "o_orderdate"), "seq").alias("l"))
    cases = last.select("case_id", stats.lookup(STAGES, F.col("l.o_orderstatus")).alias("current_stage"), F.to_date("l.o_orderdate").alias("received"))
    events = st.table(spark, d, "events")
    kind = stats.lookup({"click": "leak_review", "view": "leak_review", "purchase": "blocker", "signup": "unextractable", "error": "flag_review"}, F.col("event_type"))
    from ..operators.latest import recent_kinds

    recent = recent_kinds(events.select(F.concat(F.lit("k"), "user_id").alias("case_id"), F.col("event_id").alias("seq"), kind.alias("stage")))
    return review.scored_queue(items, cases, recent, asof)


QUEUE = LAST_ORDER + (
    ", i as (select case_id, 'blocker' as kind, issue_id as item_id, case severity when 'CRITICAL' then 10 when 'HIGH' then 7 when 'MEDIUM' then 4 when 'LOW' then 2 else 5 end as risk, 3 as ph, 0 as source_ord, "
    f"epoch(timestamp '{st.ASOF}') - epoch(od) as age_s from b "
    "union all select case_id, 'leak_review', 'doc-' || o_orderkey, 6, 2, 1, 0 from o where o_totalprice > 400000 and o_orderstatus <> 'P' "
    "union all select case_id, 'unextractable', 'mail/in-' || o_orderkey || '.eml', 4, 0, 2, 0 from o where o_totalprice < 20000), "
    "rk as (select case_id, list(kind order by seq desc) as recent from (select 'k' || user_id as case_id, event_id as seq, case event_type when 'click' then 'leak_review' when 'view' then 'leak_review' when 'purchase' then 'blocker' when 'signup' then 'unextractable' else 'flag_review' end as kind, "
    "row_number() over (partition by user_id order by event_id desc) as rn from events) where rn <= 3 group by 1), "
    f"j as (select i.*, case os when 'F' then 3 when 'O' then 2 else 1 end as cur, 30 - datediff('day', od, timestamp '{st.ASOF}') as days, coalesce(recent, []) as recent from i join l using (case_id) left join rk using (case_id)), "
    "s as (select *, 0.4::double * risk / 10 + 0.3::double * greatest(0.0::double, least(1.0::double, 1.0 - days / 30.0::double)) + 0.15::double * greatest(0.0::double, 1.0 - ph / cur::double) "
    "- 0.1::double * len(list_filter(recent, lambda k: k = kind)) / 3 + 0.05::double * (case when len(recent) > 0 and len(list_distinct(recent)) = 1 and recent[1] <> kind then 1 else 0 end) as score from j where ph <= cur) "
)


@query("action_queue", QUEUE + "select case_id, kind, item_id, risk, days as sla_days_remaining, ph as stage_position, round(score, 6) as score, round(greatest(0.0::double, age_s / 3600.0::double), 4) as age_hours from s")
def action_queue(spark, d):
    return _queue(spark, d).select(
        "case_id", "kind", "item_id", "risk", "sla_days_remaining", "stage_position", F.round("score", 6).alias("score"), F.round("age_hours", 4).alias("age_hours")
    )


@query(
    "next_best_review",
    QUEUE + "select case_id, kind, item_id from (select *, row_number() over (partition by case_id order by round(score, 9) desc, source_ord, item_id) as rn from s) where rn = 1",
)
def next_best_review(spark, d):
    queue = _queue(spark, d).withColumn("score", F.round("score", 9))
    return review.next_best(queue).select("case_id", "kind", "item_id")


@query(
    "phase_status",
    LAST_ORDER
    + """, c as (select case_id, case os when 'F' then 14 when 'O' then 7 else 5 end as a from l)
    select case_id, phase, case when c.a < f then 'pending' when c.a > t then 'done' else 'current' end as status from c, (values ('discovery', 0, 4), ('filter', 5, 6), ('redact', 7, 10), ('release', 11, 14)) v(phase, f, t)""",
)
def phase_status(spark, d):
    last = _release_verdicts(spark, d).groupBy("case_id").agg(F.max_by("o_orderstatus", "seq").alias("s"))
    return review.phase_status(last.select("case_id", stats.lookup(STAGES, F.col("s")).alias("current_stage")))


@query(
    "readiness",
    LAST_ORDER
    + """select case_id, case when os = 'F' then 'case_closed' when tp > 300000 then 'not_ready_blocked' when tp > 150000 then 'ready_with_conditions' else 'ready_approved' end as readiness from l""",
)
def readiness(spark, d):
    from ..operators import metrics

    v = _release_verdicts(spark, d)
    cases = v.groupBy("case_id").agg(F.max_by("o_orderstatus", "seq").alias("s")).select("case_id", stats.lookup(STAGES, F.col("s")).alias("current_stage"))
    return metrics.readiness(cases, v).select("case_id", "readiness")


@query(
    "waiver_state",
    """with w as (select 'case-1' as case_id, 'w-' || user_id as waiver_id, event_id as seq, case when event_type in ('view', 'click') then 'pending' else 'co_signed' end as state, event_type from events),
    p as (select waiver_id, min(seq) filter (where state = 'pending') as ps, count(*) as n from w group by 1), c as (select w.waiver_id, min(seq) as cs from w join p using (waiver_id) where state = 'co_signed' and seq > ps group by 1)
    select 'case-1' as case_id, waiver_id, case when cs is not null then 'co_signed' when ps is not null then 'pending' else 'invalid' end as state, ps as proposed_seq, cs as co_signed_seq,
    n - (case when ps is null then 0 else 1 end) - (case when cs is null then 0 else 1 end) as rejected_transitions from p left join c using (waiver_id)""",
)
def waiver_state(spark, d):
    e = st.table(spark, d, "events")
    log = e.select(
        F.lit("case-1").alias("case_id"), F.concat(F.lit("w-"), "user_id").alias("waiver_id"), F.col("event_id").alias("seq"),
        F.when(F.col("event_type").isin("view", "click"), "pending").otherwise("co_signed").alias("state"),
        F.col("event_type").alias("operator_id"), F.lit("j").alias("justification"), F.col("event_type").alias("dpo_id"),
    )
    return review.waiver_states(log).drop("operator_id", "dpo_id")


@query(
    "text_quality_bands",
    with_("docs")
    + """select case_id, q as text_quality, count(*) as n from (select case_id, case when w >= 0.9 then 'high' when w >= 0.6 then 'medium' when w >= 0.2 then 'low' else 'ocr_failure' end as q from (
    select case_id, least(len(regexp_extract_all(text, '[a-z ]')) / length(text)::double, least(1.0::double, n_chars / 1000.0::double)) as w from docs)) group by 1, 2""",
)
def text_quality_bands(spark, d):
    # the letters left are counted, as regexp_count keeps an array of all it finds; an empty text has no share, which least passes over
    plain = stats.rate(F.char_length(F.regexp_replace("text", "[^a-z ]+", "")), F.char_length("text"))
    size = F.least(F.lit(1.0), F.col("n_chars") / 1000.0)
    rows = st.docs(spark, d).select("case_id", quality.text_quality(plain, size, F.lit(1.0)).alias("text_quality"))
    return rows.groupBy("case_id", "text_quality").agg(F.count(F.lit(1)).alias("n"))
