"""Case tables derived from the provided tables, each in Spark and as the same SQL text.

A case is a document source (or a language, where exact copies should meet). Verdicts come from
`labels`, logs from `events`, queue items from `orders`, people from `customer`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import spans, vocab

ASOF = "2024-01-31 00:00:00"


def asof() -> Column:
    return F.to_timestamp(F.lit(ASOF))


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def spread(df: DataFrame, key: str) -> DataFrame:
    """Rows over all cores when the input comes in fewer pieces than there are cores.

    Text work is heavy, and one small file is one task. Inputs with enough splits stay as they are.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df


def with_(*ctes: str) -> str:
    """A WITH clause of the named CTEs and what they build on, each once, in order."""
    order: list[str] = []

    def need(name: str) -> None:
        deps, _ = CTE[name]
        for dep in deps:
            need(dep)
        if name not in order:
            order.append(name)

    for c in ctes:
        need(c)
    return "with " + ", ".join(f"{n} as ({CTE[n][1]})" for n in order) + " "


CTE: dict[str, tuple[list[str], str]] = {}


def cte(name: str, sql: str, *deps: str) -> None:
    CTE[name] = (list(deps), sql)


# ---- documents -------------------------------------------------------------

EXT = {"en": "eml", "fr": "docx", "de": "pdf", "es": "txt"}


def docs(spark: SparkSession, d: str, case: str = "source") -> DataFrame:
    return spread(table(spark, d, "documents"), "doc_id").select(
        F.col(case).alias("case_id"), F.concat(F.lit("doc-"), "doc_id").alias("ref"), "doc_id", "text", "lang", "n_chars"
    )


cte("docs", "select source as case_id, 'doc-' || doc_id as ref, doc_id, text, lang, n_chars from documents")
cte("ldocs", "select lang as case_id, 'doc-' || doc_id as ref, doc_id, text, lang, n_chars from documents")


def register(spark: SparkSession, d: str) -> DataFrame:
    rows = docs(spark, d)
    ext = F.create_map(*[F.lit(x) for p in EXT.items() for x in p])
    quality = (
        F.when(F.col("n_chars") < 120, "ocr_failure")
        .when(F.col("n_chars") < 600, "low")
        .when(F.col("lang") == "es", "unknown")
        .when(F.col("n_chars") < 3000, "medium")
        .otherwise("high")
    )
    return rows.withColumns(
        {
            "filename": F.concat("ref", F.lit("."), F.try_element_at(ext, "lang")),
            "path": F.concat("case_id", F.lit("/mail/"), "ref", F.lit("."), F.try_element_at(ext, "lang")),
            "hash": F.sha2("text", 256),
            "text_quality": quality,
            "notes": F.when(F.col("n_chars") > 8000, F.lit("long; flagged for review")),
            "mailbox_owner_email": F.when(F.col("lang") == "en", F.concat("case_id", F.lit("@example.com"))),
            "source_kind": F.lit(""),
            "status": F.when(F.col("n_chars") > 3000, "exported").when(F.col("n_chars") > 300, "redacted").otherwise("failed"),
        }
    )


cte(
    "register",
    "select *, ref || '.' || ext as filename, case_id || '/mail/' || ref || '.' || ext as path from ("
    "select *, case lang when 'en' then 'eml' when 'fr' then 'docx' when 'de' then 'pdf' when 'es' then 'txt' end as ext, "
    "sha256(text) as hash, case when n_chars < 120 then 'ocr_failure' when n_chars < 600 then 'low' when lang = 'es' then 'unknown' "
    "when n_chars < 3000 then 'medium' else 'high' end as text_quality, "
    "case when n_chars > 8000 then 'long; flagged for review' end as notes, "
    "case when lang = 'en' then case_id || '@example.com' end as mailbox_owner_email, "
    "case when n_chars > 3000 then 'exported' when n_chars > 300 then 'redacted' else 'failed' end as status from docs)",
    "docs",
)

# ---- verdicts --------------------------------------------------------------


def verdicts(spark: SparkSession, d: str) -> DataFrame:
    """Primary verdict per labelled document, in register order (`seq`)."""
    lab = table(spark, d, "labels")
    v = (
        F.when((F.col("quality") == 1) & (F.col("toxic") == 0), "biographical")
        .when(F.col("quality") == 0, "work_context_only")
        .otherwise("ambiguous")
    )
    rows = docs(spark, d).drop("text").join(lab, "doc_id", "inner")
    return rows.select(
        "case_id", "ref", "doc_id", F.col("doc_id").alias("seq"), "lang", "n_chars", "toxic", v.alias("primary_verdict")
    )


cte(
    "verdicts",
    "select case_id, ref, doc_id, doc_id as seq, lang, n_chars, toxic, case when quality = 1 and toxic = 0 then 'biographical' "
    "when quality = 0 then 'work_context_only' else 'ambiguous' end as primary_verdict from docs join labels using (doc_id)",
    "docs",
)


def rechecks(spark: SparkSession, d: str) -> DataFrame:
    """Second opinions on the excluded documents: by language, none for Spanish, errors on long texts."""
    call = (
        F.when(F.col("lang") == "en", "confirmed_work_context_only")
        .when(F.col("lang") == "de", "reclassify_to_biographical")
        .when(F.col("lang") == "fr", "reclassify_to_ambiguous")
    )
    rows = verdicts(spark, d).filter("primary_verdict = 'work_context_only' and lang <> 'es'")
    return rows.select(
        "case_id", "ref", "seq", "n_chars", call.alias("recheck_verdict"), F.when(F.col("n_chars") > 4000, "timeout").alias("error_code")
    )


cte(
    "rechecks",
    "select case_id, ref, seq, n_chars, case lang when 'en' then 'confirmed_work_context_only' when 'de' then 'reclassify_to_biographical' "
    "when 'fr' then 'reclassify_to_ambiguous' end as recheck_verdict, case when n_chars > 4000 then 'timeout' end as error_code "
    "from verdicts where primary_verdict = 'work_context_only' and lang <> 'es'",
    "verdicts",
)


def temporal(spark: SparkSession, d: str) -> DataFrame:
    window = F.when(F.col("n_chars") < 600, "out_of_scope").otherwise("in_scope")
    return docs(spark, d).drop("text").filter("n_chars < 5000").select(
        "case_id", "ref", F.col("doc_id").alias("seq"), window.alias("temporal_verdict")
    )


cte(
    "temporal",
    "select case_id, ref, doc_id as seq, case when n_chars < 600 then 'out_of_scope' else 'in_scope' end as temporal_verdict "
    "from docs where n_chars < 5000",
    "docs",
)
cte(
    "synth",
    "select *, case when out and eff = 'present' then 'ambiguous' else eff end as scope_verdict from ("
    "select *, case when reason in ('primary_biographical','recheck_reclassified_biographical') then 'present' "
    "when reason in ('recheck_confirms_wco') then 'not_present' else 'ambiguous' end as eff, "
    "coalesce(temporal_verdict = 'out_of_scope', false) as out from ("
    "select v.case_id, v.ref, v.n_chars, case primary_verdict when 'biographical' then 'present' when 'work_context_only' then 'not_present' "
    "else 'ambiguous' end as primary_scope, recheck_verdict, error_code, temporal_verdict, "
    "case when primary_verdict = 'biographical' then 'primary_biographical' when primary_verdict = 'ambiguous' then 'primary_ambiguous' "
    "when error_code is not null then 'recheck_errored:' || error_code "
    "when recheck_verdict = 'confirmed_work_context_only' then 'recheck_confirms_wco' "
    "when recheck_verdict = 'reclassify_to_biographical' then 'recheck_reclassified_biographical' "
    "when recheck_verdict = 'reclassify_to_ambiguous' then 'recheck_reclassified_ambiguous' "
    "else 'recheck_expected_but_missing_for_ref' end as reason "
    "from verdicts v left join rechecks r using (case_id, ref) left join temporal t using (case_id, ref)))",
    "verdicts", "rechecks", "temporal",
)


def dispositions(spark: SparkSession, d: str) -> DataFrame:
    return docs(spark, d).drop("text").select(
        "case_id", "ref", F.when(F.col("n_chars") >= 1000, "included").otherwise("excluded").alias("disposition")
    )


cte("dispositions", "select case_id, ref, case when n_chars >= 1000 then 'included' else 'excluded' end as disposition from docs", "docs")

# ---- logs ------------------------------------------------------------------

DECISION_OF = {
    "click": "approve",
    "view": "pending",
    "purchase": "request_reredaction",
    "signup": "mark_false_positive",
    "error": "escalate",
}
REASON_OF = {"click": "R007", "view": "R-PENDING", "purchase": "R008", "signup": "R010", "error": "R999"}


def _event_map(mapping: dict[str, str]) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for p in mapping.items() for x in p]), "event_type")


def decisions(spark: SparkSession, d: str) -> DataFrame:
    """Decision log: documents keyed by user id, kinds from the event type, in event order."""
    e = table(spark, d, "events")
    note = F.when(F.get_json_object("props", "$.k").cast("int") >= 50, F.concat(F.lit("see "), "props")).otherwise("")
    return e.select(
        F.lit("case-1").alias("case_id"),
        F.concat(F.lit("doc-"), "user_id").alias("ref"),
        F.col("event_id").alias("seq"),
        _event_map(DECISION_OF).alias("decision"),
        _event_map(REASON_OF).alias("reason_code"),
        note.alias("note"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("ts"),
    )


def _case_sql(mapping: dict[str, str]) -> str:
    return "case event_type " + " ".join(f"when '{k}' then '{v}'" for k, v in mapping.items()) + " end"


cte(
    "decisions",
    f"select 'case-1' as case_id, 'doc-' || user_id as ref, event_id as seq, {_case_sql(DECISION_OF)} as decision, "
    f"{_case_sql(REASON_OF)} as reason_code, case when cast(json_extract_string(props, '$.k') as int) >= 50 then 'see ' || props else '' end as note, "
    "strftime(ts, '%Y-%m-%dT%H:%M:%SZ') as ts from events",
)


def pipeline_log(spark: SparkSession, d: str) -> DataFrame:
    """Run log: a case per user, a stage per event type, the value as duration."""
    e = table(spark, d, "events")
    stage = F.when(F.col("event_type") == "purchase", "export").otherwise(F.col("event_type"))
    return e.select(
        F.concat(F.lit("u"), "user_id").alias("case_id"),
        F.col("event_id").alias("seq"),
        F.when(F.col("event_type") == "signup", "run_complete").otherwise("stage_end").alias("event"),
        stage.alias("stage"),
        F.when(F.col("event_type") == "error", "failed").otherwise("ok").alias("outcome"),
        F.col("value").alias("duration_s"),
        ((F.col("event_type") == "signup") & (F.col("value") > 100)).alias("halted"),
        F.when(F.col("value") > 100, "gate").alias("halt_reason"),
    )


cte(
    "plog",
    "select 'u' || user_id as case_id, event_id as seq, case when event_type = 'signup' then 'run_complete' else 'stage_end' end as event, "
    "case when event_type = 'purchase' then 'export' else event_type end as stage, "
    "case when event_type = 'error' then 'failed' else 'ok' end as outcome, value as duration_s, "
    "(event_type = 'signup' and value > 100) as halted, case when value > 100 then 'gate' end as halt_reason from events",
)


def audit_events(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    return e.select(
        F.concat(F.lit("u"), "user_id").alias("case_id"),
        F.col("event_id").alias("seq"),
        "event_type",
        F.concat_ws("|", F.col("event_id").cast("string"), "event_type", "props").alias("body"),
    )


cte("audit", "select 'u' || user_id as case_id, event_id as seq, event_type, event_id || '|' || event_type || '|' || props as body from events")

# ---- entities --------------------------------------------------------------

WORD = "[A-Z][a-z]{9,}"


def subjects(spark: SparkSession, d: str) -> DataFrame:
    """One subject per case, named by words of the case's own documents."""
    word = F.nullif(F.regexp_extract("text", WORD, 0), F.lit(""))
    mail = F.nullif(F.regexp_extract("text", vocab.EMAIL, 0), F.lit(""))
    return (
        docs(spark, d)
        .groupBy("case_id")
        .agg(F.min(word).alias("full_name"), F.array(F.max(word)).alias("aliases"), F.min(mail).alias("email"))
        .withColumns(
            {
                "additional_emails": spans.empty("string"),
                "subject_protected_phrases": F.array(F.lower(F.substring("full_name", 1, 8)), F.lit("")),
            }
        )
    )


def read_by_model(spark: SparkSession, d: str) -> DataFrame:
    """Documents with a stand-in for a model's reply: their long capitalised words, once each."""
    words = F.array_distinct(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)))
    kind = lambda w: F.when(F.char_length(w) >= 13, "organisation").otherwise("third_party")
    found = F.transform(
        words, lambda w: F.struct(w.alias("text"), F.lit("person").alias("type"), kind(w).alias("classification"))
    )
    return docs(spark, d).withColumn("found", found)


def tags(spark: SparkSession, d: str, cases: list[str] | None = None) -> DataFrame:
    from ..operators import entities

    return entities.build_tags(
        read_by_model(spark, d), entities.subject_identifiers(subjects(spark, d)), cases=cases
    )


EMAIL_SQL = vocab.EMAIL.replace("'", "''")
cte(
    "subjects",
    f"select case_id, min(nullif(regexp_extract(text, '{WORD}', 0), '')) as full_name, max(nullif(regexp_extract(text, '{WORD}', 0), '')) as alias, "
    f"min(nullif(regexp_extract(text, '{EMAIL_SQL}', 0), '')) as email from docs group by case_id",
    "docs",
)
cte(
    "ents",
    "select case_id, ref, w as etext, 'llm_person' as etype, n, own, case when own then 'data_subject' when length(w) >= 13 then 'organisation' else 'third_party' end as cls, "
    "case when own then 'preserve' when length(w) >= 13 then 'flag' else 'redact' end as redact from ("
    "select x.case_id, x.ref, x.w, (length(lower(text)) - length(replace(lower(text), lower(w), ''))) // length(w) as n, "
    "(contains(lower(w), lower(full_name[1:8])) or contains(lower(full_name[1:8]), lower(w)) or contains(lower(w), lower(full_name)) "
    "or contains(lower(w), lower(alias)) or coalesce(contains(lower(w), lower(email)), false)) as own "
    f"from (select case_id, ref, text, unnest(list_distinct(regexp_extract_all(text, '{WORD}'))) as w from docs) x join subjects using (case_id)) "
    "union all "
    "select case_id, ref, m, 'email', 1, own, case when own then 'data_subject' else 'third_party' end, case when own then 'preserve' else 'redact' end from ("
    "select x.case_id, x.ref, m, (contains(lower(m), lower(full_name[1:8])) or contains(lower(full_name[1:8]), lower(m)) or contains(lower(m), lower(full_name)) "
    "or contains(lower(m), lower(alias)) or coalesce(contains(lower(m), lower(email)), false)) as own "
    f"from (select case_id, ref, unnest(regexp_extract_all(text, '{EMAIL_SQL}')) as m from docs) x join subjects using (case_id))",
    "docs", "subjects",
)

# every span of ents: the words by the pieces of the text between them, the addresses by the pattern's
cte(
    "ent_spans",
    "select e.case_id, e.ref, e.etext, e.etype, e.cls, e.redact, cast(p.stop - length(e.etext) as int) as start, cast(p.stop as int) as \"end\" "
    "from (select distinct case_id, ref, etext, etype, cls, redact from ents where etype <> 'email') e join ("
    "select ref, w, i, sum(length(piece) + length(w)) over (partition by ref, w order by i) as stop, last from ("
    "select ref, w, unnest(range(1, len(pieces) + 1)) as i, unnest(pieces) as piece, len(pieces) as last from ("
    f"select ref, w, string_split(lower(text), lower(w)) as pieces from (select ref, text, unnest(list_distinct(regexp_extract_all(text, '{WORD}'))) as w from docs)))"
    ") p on p.ref = e.ref and p.w = e.etext where p.i < p.last "
    "union all "
    "select e.case_id, e.ref, e.etext, e.etype, e.cls, e.redact, cast(p.stop - length(p.hit) as int), cast(p.stop as int) "
    "from (select distinct case_id, ref, etext, etype, cls, redact from ents where etype = 'email') e join ("
    "select ref, hit, sum(length(gap) + length(hit)) over (partition by ref order by i) as stop from ("
    "select ref, unnest(range(1, len(hits) + 1)) as i, unnest(hits) as hit, unnest(gaps[1:len(hits)]) as gap from ("
    f"select ref, regexp_extract_all(text, '{EMAIL_SQL}') as hits, regexp_split_to_array(text, '{EMAIL_SQL}') as gaps from docs))"
    ") p on p.ref = e.ref and p.hit = e.etext",
    "docs", "ents",
)

# ---- people ----------------------------------------------------------------


def mentions(spark: SparkSession, d: str) -> DataFrame:
    """A mention of a customer per order line; the part is the document it stands in."""
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    li = table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_discount", "l_tax", "l_quantity")
    return li.join(o, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.concat(F.lit("case-"), "o_orderstatus").alias("case_id"),
        F.concat(F.lit("cust-"), "o_custkey").alias("cluster"),
        F.concat(F.lit("doc-"), "l_partkey").alias("ref"),
        (1 - F.col("l_discount")).alias("confidence"),
        (F.col("l_tax") * 10).alias("is_subject_confidence"),
        "l_quantity",
    )


cte(
    "mentions",
    "select 'case-' || o_orderstatus as case_id, 'cust-' || o_custkey as cluster, 'doc-' || l_partkey as ref, 1 - l_discount as confidence, "
    "l_tax * 10 as is_subject_confidence, l_quantity from lineitem join orders on l_orderkey = o_orderkey",
)


def people(spark: SparkSession, d: str) -> DataFrame:
    """Clusters from customers: mentions are orders, documents are order months, the case is the segment."""
    o = table(spark, d, "orders").select("o_custkey", "o_orderdate", "o_totalprice")
    per_month = o.groupBy("o_custkey", F.trunc("o_orderdate", "month").alias("m")).agg(F.count(F.lit(1)).alias("n"))
    counts = per_month.groupBy("o_custkey").agg(F.sum("n").alias("mention_count"), F.count(F.lit(1)).alias("distinct_doc_count"))
    c = table(spark, d, "customer")
    rows = c.join(counts, F.col("c_custkey") == F.col("o_custkey"), "left")
    return rows.select(
        F.col("c_mktsegment").alias("case_id"),
        F.col("c_custkey").alias("custkey"),
        F.col("c_name").alias("canonical_name"),
        F.coalesce("mention_count", F.lit(0)).alias("mention_count"),
        F.coalesce("distinct_doc_count", F.lit(0)).alias("distinct_doc_count"),
        (F.col("c_nationkey") == 7).alias("is_data_subject"),
        (F.col("c_nationkey") / 25.0).alias("is_subject_confidence"),
        F.when(F.col("c_acctbal") > 0, F.round(F.col("c_acctbal") / 10000.0, 4)).alias("subject_centricity_score"),
        F.when(F.col("c_acctbal") > 0, F.array(F.concat(F.lower("c_name"), F.lit("@example.com")))).otherwise(spans.empty("string")).alias("emails"),
        F.array(F.concat(F.lit("020"), F.col("c_custkey").cast("string"))).alias("phones"),
    )


cte(
    "people",
    "select c_mktsegment as case_id, c_custkey as custkey, c_name as canonical_name, coalesce(mention_count, 0) as mention_count, "
    "coalesce(distinct_doc_count, 0) as distinct_doc_count, (c_nationkey = 7) as is_data_subject, c_nationkey / 25.0::double as is_subject_confidence, "
    "case when c_acctbal > 0 then round(c_acctbal / 10000.0::double, 4) end as subject_centricity_score, (c_acctbal > 0) as has_email from customer left join ("
    "select o_custkey, count(*) as mention_count, count(distinct date_trunc('month', o_orderdate)) as distinct_doc_count from orders group by 1) on c_custkey = o_custkey",
)


def people_decisions(spark: SparkSession, d: str) -> DataFrame:
    """Operator decisions on clusters, one per order in order-key order, by order status and price."""
    from ..functions import hashing

    o = table(spark, d, "orders")
    action = (
        F.when(F.col("o_totalprice") > 400000, "merge_with")
        .when(F.col("o_totalprice") > 350000, "mark_subject_alias")
        .when(F.col("o_orderstatus") == "F", "preserve")
        .otherwise("accept_as_third_party")
    )
    # merges go to the lowest name of the nation and segment, so that many clusters share a target, urgent ones
    # to the highest, so that merges also chain, cross and come too late
    ends = F.min("c_name").alias("low"), F.max("c_name").alias("high")
    nation = table(spark, d, "customer").groupBy("c_nationkey", "c_mktsegment").agg(*ends)
    c = table(spark, d, "customer").join(nation, ["c_nationkey", "c_mktsegment"])
    target_name = F.when(F.col("o_orderpriority") == "1-URGENT", F.col("high")).otherwise(F.col("low"))
    return o.join(c, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("c_mktsegment").alias("case_id"),
        hashing.cluster_id(F.col("c_name")).alias("cluster_id"),
        F.col("o_orderkey").alias("seq"),
        action.alias("action"),
        F.col("o_orderpriority").alias("note"),
        F.when(action == "merge_with", hashing.cluster_id(target_name)).alias("merge_target_id"),
    )


cte(
    "people_decisions",
    "select c.c_mktsegment as case_id, sha1(c.c_name)[1:16] as cluster_id, o_orderkey as seq, "
    "case when o_totalprice > 400000 then 'merge_with' when o_totalprice > 350000 then 'mark_subject_alias' when o_orderstatus = 'F' then 'preserve' else 'accept_as_third_party' end as action, "
    "o_orderpriority as note, sha1(case when o_orderpriority = '1-URGENT' then t.high else t.low end)[1:16] as target_id from orders join customer c on o_custkey = c.c_custkey "
    "join (select c_nationkey, c_mktsegment, min(c_name) as low, max(c_name) as high from customer group by 1, 2) t on t.c_nationkey = c.c_nationkey and t.c_mktsegment = c.c_mktsegment",
)
