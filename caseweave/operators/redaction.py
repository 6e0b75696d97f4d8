"""Flag resolution, overlays, redacted text, plans and leak checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import spans
from .latest import latest_per_key

VERDICT_STATE = {"redact": "redact", "preserve": "preserve"}


def resolve_all_flags(entities: DataFrame, target: str) -> DataFrame:
    """Every open flag becomes `redact` or `preserve`."""
    if target not in VERDICT_STATE:
        raise ValueError(f"unknown target {target!r}")
    return entities.withColumn("redact", F.when(F.col("redact") == "flag", target).otherwise(F.col("redact")))


def resolve_flags(entities: DataFrame, decisions: DataFrame) -> DataFrame:
    """Entities with their flags resolved by decisions; the spans themselves are never rewritten.

    decisions: case_id, seq, scope (cluster / instance), text, classification, ref, start, end,
    verdict (redact / preserve / escalate). An instance decision outranks its cluster's;
    `escalate` leaves the flag open.
    """
    acting = decisions.filter(F.col("verdict").isin(*VERDICT_STATE))
    cluster_keys = ["case_id", "text", "classification"]
    instance_keys = [*cluster_keys, "ref", "start", "end"]
    cluster = latest_per_key(
        acting.filter("scope = 'cluster'").select(*cluster_keys, "seq", F.col("verdict").alias("cluster_verdict")),
        cluster_keys,
    ).drop("seq", "n_rows")
    instance = latest_per_key(
        acting.filter("scope = 'instance'").select(*instance_keys, "seq", F.col("verdict").alias("instance_verdict")),
        instance_keys,
    ).drop("seq", "n_rows")
    rows = entities.join(cluster, cluster_keys, "left").join(instance, instance_keys, "left")
    decided = F.coalesce("instance_verdict", "cluster_verdict")
    state = F.when((F.col("redact") == "flag") & decided.isNotNull(), decided).otherwise(F.col("redact"))
    return rows.withColumn("redact", state).drop("cluster_verdict", "instance_verdict")


def stale_instance_decisions(entities: DataFrame, decisions: DataFrame) -> DataFrame:
    """Instance decisions whose coordinates name no open flag."""
    keys = ["case_id", "ref", "start", "end", "text", "classification"]
    open_flags = entities.filter("redact = 'flag'").select(*keys)
    return decisions.filter("scope = 'instance'").join(open_flags, keys, "left_anti")


def overlay(tags: DataFrame) -> DataFrame:
    """Valid spans per document with their badge code, in start order."""
    usable = F.filter("entities", lambda e: e["start"].isNotNull() & e["end"].isNotNull())
    coded = F.transform(
        usable,
        lambda e, i: F.struct(
            e["start"].alias("start"),
            i.alias("ord"),
            e["end"].alias("end"),
            e["redact"].alias("redact"),
            spans.badge(e["classification"], e["redact"]).alias("code"),
            e["text"].alias("text"),
        ),
    )
    return tags.select("case_id", "ref", F.array_sort(coded).alias("overlay"))


def redact_text(docs: DataFrame, overlays: DataFrame) -> DataFrame:
    """Document text with codes in place of redacted spans; documents without spans are unchanged."""
    rows = docs.select("case_id", "ref", "text").join(overlays, ["case_id", "ref"], "left")
    cut = spans.apply_overlay(F.col("text"), F.col("overlay"))
    return rows.select(
        "case_id", "ref", F.when(F.coalesce(F.size("overlay"), F.lit(0)) > 0, cut).otherwise(F.col("text")).alias("redacted")
    )


def leak_check(redacted: DataFrame, tags: DataFrame, protected: DataFrame | None = None) -> DataFrame:
    """Documents whose redacted text still holds a redacted entity's text.

    Terms equal to, or inside, a protected phrase of the case are not leaks.
    """
    terms = F.array_distinct(
        F.transform(
            F.filter("entities", lambda e: e["redact"].isin("redact", "flag") & (F.char_length(e["text"]) > 0)),
            lambda e: e["text"],
        )
    )
    rows = redacted.join(tags.select("case_id", "ref", terms.alias("terms")), ["case_id", "ref"], "inner")
    if protected is None:
        rows = rows.withColumn("protected", spans.empty("string"))
    else:
        rows = rows.join(protected.select("case_id", "protected"), "case_id", "left")
        rows = rows.withColumn("protected", F.coalesce("protected", spans.empty("string")))
    low = F.lower("redacted")
    leaks = F.filter(
        "terms",
        lambda t: F.contains(low, F.lower(t)) & ~F.exists("protected", lambda p: F.contains(p, F.lower(t))),
    )
    return rows.select("case_id", "ref", F.array_sort(leaks).alias("leaks")).withColumn(
        "status", F.when(F.size("leaks") > 0, "failed").otherwise("redacted")
    )


def leak_list(failed: DataFrame, checks: DataFrame, tags: DataFrame, decisions: DataFrame) -> DataFrame:
    """Failed redactions with their leak terms (distinct, and the first eight), counts and latest decision."""
    key = ["case_id", "ref"]
    last = latest_per_key(decisions, key).select(*key, "decision", "reason_code", F.col("ts").alias("decision_ts"))
    none = spans.empty("string")
    return (
        failed.filter("status = 'failed'")
        .select(*key, "filename")
        .join(checks.select(*key, "leaks"), key, "left")
        .join(tags.select(*key, "entity_count", "redact_count"), key, "left")
        .join(last, key, "left")
        .select(
            *key,
            "filename",
            F.size(F.coalesce("leaks", none)).alias("leaks_count"),
            F.slice(F.coalesce("leaks", none), 1, 8).alias("leaks_sample"),
            F.array_sort(F.array_distinct(F.coalesce("leaks", none))).alias("leaks_distinct"),
            F.coalesce("entity_count", F.lit(0)).alias("entity_count"),
            F.coalesce("redact_count", F.lit(0)).alias("redact_count"),
            F.coalesce("decision", F.lit("pending")).alias("decision"),
            F.coalesce("reason_code", F.lit("")).alias("reason_code"),
            F.coalesce("decision_ts", F.lit("")).alias("decision_ts"),
        )
    )


def redaction_plan(verdicts: DataFrame, tags: DataFrame) -> DataFrame:
    """One plan row per in-scope document: the spans to redact and why."""
    key = ["case_id", "ref"]
    wanted = F.filter("entities", lambda e: e["redact"].isin("redact", "flag"))
    cuts = F.array_sort(
        F.transform(wanted, lambda e: F.struct(e["start"].alias("start"), e["end"].alias("end")))
    )
    plan = verdicts.filter("scope_verdict = 'present'").select(*key).join(tags, key, "left")
    cuts = F.coalesce(cuts, spans.empty("struct<start:int,end:int>"))
    return plan.select(
        *key, cuts.alias("spans"), F.when(F.size(cuts) > 0, "third_party_data").otherwise("none").alias("reason_code")
    )


def plan_without_output(plan: DataFrame, files: DataFrame) -> DataFrame:
    """Planned documents for which no redacted file exists."""
    return plan.select("case_id", "ref").join(files.select("case_id", "ref"), ["case_id", "ref"], "left_anti")


def anonymise(docs: DataFrame, tags: DataFrame, labels: DataFrame) -> DataFrame:
    """Text with cluster labels such as [PERSON_C3] in place of people; the subject stays readable.

    labels: case_id, name (lower case), label. Names are matched by an equi-join on the spans of
    each document, so a name used everywhere is only ever a key of one small row.
    """
    key = ["case_id", "ref"]
    rows = tags.select(*key, F.posexplode("entities").alias("ord", "e")).filter("e.redact in ('redact','flag')")
    rows = rows.withColumn("name", F.lower("e.text")).join(labels, ["case_id", "name"], "left")
    cut = F.struct(
        F.col("e.start").alias("start"),
        F.col("ord"),
        F.col("e.end").alias("end"),
        F.lit("redact").alias("redact"),
        F.coalesce("label", F.upper("e.type")).alias("code"),
    )
    overlays = rows.groupBy(*key).agg(F.array_sort(F.collect_list(cut)).alias("overlay"))
    return redact_text(docs, overlays).withColumnRenamed("redacted", "anonymised")


def juror_disagreements(verdicts: DataFrame) -> DataFrame:
    """Documents where jurors A and B differ, on the finding itself or on its categories."""

    def by(juror: str, name: str) -> Column:
        return F.max(F.when(F.col("juror") == juror, F.col(name)))

    sorted_cats = verdicts.withColumn("cats", F.array_join(F.array_sort("pii_categories"), ","))
    pair = sorted_cats.groupBy("case_id", "ref").agg(
        by("A", "has_third_party_pii").alias("has_a"),
        by("B", "has_third_party_pii").alias("has_b"),
        by("A", "cats").alias("cats_a"),
        by("B", "cats").alias("cats_b"),
    )
    both = pair.filter("has_a is not null and has_b is not null")
    kind = F.when(F.col("has_a") != F.col("has_b"), "boolean").when(
        F.col("cats_a") != F.col("cats_b"), "categories"
    )
    return (
        both.withColumn("disagreement_kind", kind)
        .filter("disagreement_kind is not null")
        .withColumn("disposition", F.lit("operator_review_required"))
    )
