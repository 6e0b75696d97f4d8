"""Entity annotations: detection, classification, counts, clusters, context."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import spans, text as tx
from . import needles

ENTITY = (
    "struct<start:int,end:int,text:string,type:string,source:string,"
    "classification:string,redact:string>"
)


def subject_identifiers(subjects: DataFrame) -> DataFrame:
    """Per case, the lower-cased strings that identify the subject, and the protected phrases.

    Full name, aliases and their words of more than two characters, and e-mail addresses.
    Blank protected phrases are dropped: an empty one would match every entity.
    """
    none = spans.empty("string")
    names = F.concat(F.array(F.coalesce("full_name", F.lit(""))), F.coalesce("aliases", none))
    words = F.filter(
        F.flatten(F.transform(names, lambda n: F.split(n, r"(?U)\s+"))), lambda w: F.char_length(w) > 2
    )
    mails = F.concat(F.array(F.coalesce("email", F.lit(""))), F.coalesce("additional_emails", none))
    lowered = F.transform(F.concat(names, words, mails), lambda x: F.lower(x))
    phrases = F.transform(F.coalesce("subject_protected_phrases", none), lambda p: F.lower(p))
    return subjects.select(
        "case_id",
        F.array_distinct(F.filter(lowered, lambda x: F.trim(x) != "")).alias("subject_ids"),
        F.filter(phrases, lambda p: F.trim(p) != "").alias("protected"),
    )


def classify(value: Column, model_class: Column, subject_ids: Column, protected: Column) -> Column:
    """struct(classification, redact): protected phrase, then subject identifier, then the model's word."""
    low = F.lower(value)
    shielded = F.exists(protected, lambda p: F.contains(low, p) | F.contains(p, low))
    subject = F.exists(subject_ids, lambda s: F.contains(low, s))
    own = F.coalesce(shielded | subject, F.lit(False)) | F.coalesce(model_class == "data_subject", F.lit(False))
    return F.struct(
        F.when(own, "data_subject")
        .when(model_class == "third_party", "third_party")
        .when(model_class == "organisation", "organisation")
        .otherwise("unknown")
        .alias("classification"),
        F.when(own, "preserve").when(model_class == "third_party", "redact").otherwise("flag").alias("redact"),
    )


def build_tags(
    docs: DataFrame, subjects: DataFrame, model_entities: DataFrame | None = None, cases: list[str] | None = None
) -> DataFrame:
    """Entity array per document from the model layer and the deterministic layer.

    docs: case_id, ref, text. subjects: output of subject_identifiers. model_entities:
    case_id, ref, found array<struct<text,type,classification>>; where the documents carry
    `found` themselves no join, and no shuffle of the texts, is needed. Every occurrence of a model
    entity is located in the text, all entities of a document in one walk; one (start, end, text) is kept once,
    first layer first. Contact details that are not the subject's own default to third_party / redact.
    `cases` keeps only those cases: the walk is a barrier that a later filter does not pass, this one reaches the scan.
    """
    none = spans.empty("struct<text:string,type:string,classification:string>")
    if cases is not None:
        docs, subjects = (x.filter(F.col("case_id").isin(*cases)) for x in (docs, subjects))
    rows = docs.join(subjects, "case_id", "left").withColumns(
        {
            "subject_ids": F.coalesce("subject_ids", spans.empty("string")),
            "protected": F.coalesce("protected", spans.empty("string")),
        }
    )
    if "found" not in docs.columns:
        if model_entities is None:
            rows = rows.withColumn("found", none)
        else:
            rows = rows.join(model_entities.select("case_id", "ref", "found"), ["case_id", "ref"], "left")
    ids, shield = F.col("subject_ids"), F.col("protected")

    def from_model(entity: Column) -> Column:
        def shaped(value: Column) -> Column:
            label = classify(value, entity["classification"], ids, shield)
            return F.struct(
                value.alias("value"),
                F.when(F.char_length(value) >= 2, spans.folded(value)).alias("low"),
                F.concat(F.lit("llm_"), F.coalesce(entity["type"], F.lit("other"))).alias("type"),
                label["classification"].alias("classification"),
                label["redact"].alias("redact"),
            )

        return spans.let(tx.strip(entity["text"]), shaped)

    def from_pattern(span: Column, found: Column) -> Column:
        same = F.filter(found, lambda e: F.lower(e["text"]) == F.lower(span["text"]))
        label = classify(span["text"], F.try_element_at(same, F.lit(-1))["classification"], ids, shield)
        own = label["classification"] == "data_subject"
        return F.struct(
            span["start"].alias("start"), span["end"].alias("end"), span["text"].alias("text"), span["type"].alias("type"),
            F.lit("regex").alias("source"),
            F.when(own, "data_subject").otherwise("third_party").alias("classification"),
            F.when(own, "preserve").otherwise("redact").alias("redact"),
        )

    both = spans.let(
        F.coalesce("found", none),
        lambda found: F.struct(
            F.transform(found, from_model).alias("model"),
            F.transform(spans.contact_spans(F.col("text")), lambda s: from_pattern(s, found)).alias("contact"),
        ),
    )
    rows = rows.select("case_id", "ref", both.alias("layers"), spans.folded(F.col("text")).alias("low"))
    rows = rows.select("case_id", "ref", "low", F.col("layers.model").alias("model"), F.col("layers.contact").alias("contact"))
    wanted = F.transform("model", lambda e: F.struct(e["value"].alias("value"), e["low"].alias("low")))
    fixed = F.transform("contact", lambda s: F.struct(s["start"].alias("start"), s["text"].alias("text")))
    walked = needles.locate(rows, "low", wanted, fixed)

    def placed(entity: Column, starts: Column) -> Column:
        return F.transform(starts, lambda at: F.struct(
            at.alias("start"), (at + F.char_length(entity["value"])).alias("end"), entity["value"].alias("text"),
            entity["type"].alias("type"), F.lit("model").alias("source"),
            entity["classification"].alias("classification"), entity["redact"].alias("redact"),
        ))

    fresh = F.filter("contact", lambda _, i: F.get("fresh", i))
    every = F.concat(F.flatten(F.zip_with("model", "starts", placed)), fresh)
    return with_counts(walked.select("case_id", "ref", every.alias("entities")))


def with_counts(tags: DataFrame) -> DataFrame:
    """Entity, redact and flag counts of each document's entity array."""
    state = lambda v: F.size(F.filter("entities", lambda e: e["redact"] == v))
    return tags.withColumns(
        {
            "entity_count": F.size("entities"),
            "redact_count": state("redact"),
            "flag_count": state("flag"),
        }
    )


def entity_rows(tags: DataFrame) -> DataFrame:
    """One row per entity span."""
    return tags.select("case_id", "ref", F.posexplode("entities").alias("ord", "e")).select(
        "case_id", "ref", "ord", "e.*"
    )


def contact_rows(docs: DataFrame) -> DataFrame:
    """One row per contact detail found in a document: a map-only job."""
    found = docs.select("case_id", "ref", F.explode(spans.contact_spans(F.col("text"))).alias("s"))
    return found.select("case_id", "ref", "s.*")


def contact_counts(docs: DataFrame) -> DataFrame:
    """Per case: documents, documents with hits, entities by type."""
    rows = docs.select("case_id", spans.contact_spans(F.col("text")).alias("s"))
    of = lambda k: F.size(F.filter("s", lambda x: x["type"] == k))
    return rows.groupBy("case_id").agg(
        F.count(F.lit(1)).alias("documents"),
        F.count_if(F.size("s") > 0).alias("documents_with_entities"),
        F.sum(F.size("s")).alias("entity_count"),
        F.sum(of("email")).alias("emails"),
        F.sum(of("phone_uk")).alias("phones"),
        F.sum(of("nino")).alias("ninos"),
    )


def flag_clusters(entities: DataFrame) -> DataFrame:
    """Open flags grouped by (text, classification): instances and distinct documents.

    The refs of a cluster are given one per row by `flag_cluster_refs`: a common text may
    occur in a large part of the corpus, and is never gathered into one value.
    """
    per_doc = (
        entities.filter("redact = 'flag'")
        .groupBy("case_id", "text", "classification", "ref")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return per_doc.groupBy("case_id", "text", "classification").agg(
        F.sum("n").alias("instance_count"), F.count(F.lit(1)).alias("distinct_docs")
    )


def flag_cluster_refs(entities: DataFrame) -> DataFrame:
    return entities.filter("redact = 'flag'").select("case_id", "text", "classification", "ref").distinct()


def flag_instances(entities: DataFrame, docs: DataFrame, half: int = 60) -> DataFrame:
    """Each open flag with the text around it."""
    rows = entities.filter("redact = 'flag'").join(
        docs.select("case_id", "ref", F.col("text").alias("body")), ["case_id", "ref"], "left"
    )
    before, after = spans.snippet(F.col("body"), F.col("start"), F.col("end"), half)
    return rows.select(
        *(c for c in ("type",) if c in entities.columns), "case_id", "ref", "text", "classification", "start", "end",
        before.alias("snippet_before"), after.alias("snippet_after"),
    )


def pending_flags(entities: DataFrame, register: DataFrame) -> DataFrame:
    """Per case: open flags, and register notes that ask for review."""
    flags = entities.groupBy("case_id").agg(F.count_if(F.col("redact") == "flag").alias("entity_flags"))
    notes = register.groupBy("case_id").agg(
        F.count_if(F.contains(F.coalesce("notes", F.lit("")), F.lit("flagged for review"))).alias("register_notes")
    )
    return notes.join(flags, "case_id", "full").na.fill(0)


def findings_by_ref(findings: DataFrame) -> DataFrame:
    """Detector findings as one sorted array per document; documents without any are absent."""
    item = F.struct("stage", "surface", "type", "detector", "confidence")
    return findings.groupBy("case_id", "ref").agg(
        F.array_sort(F.collect_list(item)).alias("entities"), F.count(F.lit(1)).alias("n_findings")
    )
