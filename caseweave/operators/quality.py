"""Validation: required fields, artefact rules, intake checks, gates, provenance."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import stats, times, vocab


def required_fields(rows: DataFrame, fields: list[str], keys: list[str] | None = None) -> DataFrame:
    """Missing values per required field, in one pass."""
    keys = keys or ["case_id"]
    counts = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count_if(F.col(f).isNull()).alias(f"missing_{f}") for f in fields],
    )
    return counts.withColumn("ok", reduce(lambda a, b: a & b, [F.col(f"missing_{f}") == 0 for f in fields]))


def first_findings(rows: DataFrame, bad: Column, ref: str = "ref", n: int = 5) -> DataFrame:
    """The first n offending refs per case, in ref order, limited in every task before the shuffle."""
    from pyspark.sql import Window

    order = Window.partitionBy("case_id").orderBy(ref)
    return (
        rows.filter(bad).select("case_id", ref).withColumn("rn", F.row_number().over(order)).filter(F.col("rn") <= n)
    )


def checks(rows: DataFrame, rules: dict[str, tuple[Column, str]], nonempty: bool = True) -> DataFrame:
    """Rule results per case: (check, severity, n_bad). `rules` maps a name to (bad-row condition, severity)."""
    counts = rows.groupBy("case_id").agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count_if(F.coalesce(bad, F.lit(False))).alias(f"r{i}") for i, (bad, _) in enumerate(rules.values())],
    )
    cells = [
        F.struct(F.lit(name).alias("check"), F.lit(sev).alias("level"), F.col(f"r{i}").alias("n_bad"))
        for i, (name, (_, sev)) in enumerate(rules.items())
    ]
    out = counts.select("case_id", "n_rows", F.inline(F.array(*cells)))
    return out.select(
        "case_id", "check", "n_rows", "n_bad", F.when(F.col("n_bad") > 0, F.col("level")).otherwise("info").alias("severity")
    )


def empty_cases(cases: DataFrame, rows: DataFrame, check: str) -> DataFrame:
    """Critical finding for each case that has no row at all in an artefact."""
    return cases.select("case_id").join(rows.select("case_id"), "case_id", "left_anti").select(
        "case_id", F.lit(check).alias("check"), F.lit(0).cast("bigint").alias("n_rows"),
        F.lit(0).cast("bigint").alias("n_bad"), F.lit("critical").alias("severity"),
    )


def check_register(register: DataFrame, texts: DataFrame) -> DataFrame:
    """Every register entry has a ref and an extracted text."""
    marked = register.join(
        texts.select("case_id", "ref").distinct().withColumn("has_text", F.lit(True)), ["case_id", "ref"], "left"
    )
    return checks(
        marked,
        {
            "register_ref": (F.coalesce("ref", F.lit("")) == "", "critical"),
            "register_text": (F.col("has_text").isNull(), "critical"),
        },
    )


def check_embeddings(rows: DataFrame, dim: int) -> DataFrame:
    """Required fields, dimension and not-a-number over all rows."""
    nan = F.exists("embedding", lambda v: F.isnan(v) | v.isNull())
    return checks(
        rows,
        {
            "embed_fields": (F.col("ref").isNull() | F.col("embedding").isNull() | F.col("upstream_hash").isNull(), "critical"),
            "embed_dim": (F.size("embedding") != dim, "critical"),
            "embed_nan": (nan, "critical"),
        },
    )


def check_prefilter(rows: DataFrame) -> DataFrame:
    score = F.col("cosine_score")
    return checks(
        rows,
        {
            "prefilter_fields": (F.col("ref").isNull() | score.isNull() | F.col("passes").isNull(), "critical"),
            "prefilter_range": (~score.between(-1.001, 1.001) | F.isnan(score), "critical"),
        },
    )


def check_rerank(rows: DataFrame, mode: str) -> DataFrame:
    """Required fields; and a warning for a case in which no row was made in the given mode. Nothing with reranking off."""
    if mode == "off":
        rows = rows.limit(0)
    needed = ["ref", "rerank_score", "would_drop", "mode", "upstream_hash"]
    missing = F.col(needed[0]).isNull()
    for name in needed[1:]:
        missing = missing | F.col(name).isNull()
    found = checks(rows, {"rerank_fields": (missing, "critical"), "rerank_mode": (~F.col("mode").eqNullSafe(mode), "warning")})
    some = (F.col("check") == "rerank_mode") & (F.col("n_bad") < F.col("n_rows"))
    return found.withColumn("severity", F.when(some, "info").otherwise(F.col("severity")))


def check_classified(rows: DataFrame) -> DataFrame:
    allowed = ["confirmed", "disputed", "uncertain"]
    return checks(
        rows,
        {
            "classify_fields": (F.col("ref").isNull() | F.col("entities").isNull(), "critical"),
            "classify_verdict": (~F.coalesce("in_scope_recheck", F.lit("")).isin(*allowed), "critical"),
        },
    )


def check_verifier(rows: DataFrame, synthetic: bool = False) -> DataFrame:
    return checks(rows, {"verifier_high": (F.col("severity") == "high", "warning" if synthetic else "critical")})


def upstream_consistency(rows: DataFrame, artefact: Column) -> DataFrame:
    """More than one recorded upstream hash within an artefact is a warning."""
    distinct = rows.groupBy("case_id", artefact.alias("artefact"), "upstream_hash").agg(F.count(F.lit(1)).alias("n"))
    return distinct.groupBy("case_id", "artefact").agg(
        F.count(F.lit(1)).alias("distinct_hashes"), F.sum("n").alias("n_rows")
    ).withColumn("severity", F.when(F.col("distinct_hashes") > 1, "warning").otherwise("info"))


def incomplete(register: DataFrame, rows: DataFrame) -> DataFrame:
    """Register refs that have no row in a later artefact."""
    return register.select("case_id", "ref").join(rows.select("case_id", "ref"), ["case_id", "ref"], "left_anti")


def extraction_gate(register: DataFrame, cases: DataFrame | None = None) -> DataFrame:
    """Share of failed extractions per case: over 50 % halts, over 10 % warns, both strictly; no refs halts."""
    quality = F.when(F.coalesce("text_quality", F.lit("")) == "", "unknown").otherwise(F.col("text_quality"))
    counts = register.groupBy("case_id").agg(
        F.count(F.lit(1)).alias("refs_total"), F.count_if(quality == "ocr_failure").alias("ocr_failures")
    )
    if cases is not None:
        counts = cases.select("case_id").join(counts, "case_id", "left").na.fill(0)
    share = stats.rate(F.col("ocr_failures"), F.col("refs_total"))
    return counts.withColumn("rate", share).withColumn(
        "gate",
        F.when(F.col("refs_total") == 0, "empty_ingest")
        .when(F.col("rate") > 0.50, "catastrophic")
        .when(F.col("rate") > 0.10, "warning")
        .otherwise("ok"),
    )


def text_quality(confidence: Column, density: Column, yield_ratio: Column, cuts: tuple = (0.9, 0.6, 0.2)) -> Column:
    """Quality band of a document from the weakest of three ratios; the cut-offs are a parameter."""
    worst = F.least(confidence, density, yield_ratio)
    high, medium, low = cuts
    return (
        F.when(worst.isNull(), "unknown")
        .when(worst >= high, "high")
        .when(worst >= medium, "medium")
        .when(worst >= low, "low")
        .otherwise("ocr_failure")
    )


def reason_code_audit(decisions: DataFrame) -> DataFrame:
    """Each decision with the fault of its reason code, if any."""
    known = {code: needs for code, _, needs in vocab.REASON_CODES}
    needs = stats.lookup(known, F.coalesce("reason_code", F.lit("")))
    error = (
        F.when(F.coalesce("reason_code", F.lit("")) == "", "missing_code")
        .when(needs.isNull(), "unknown_code")
        .when(needs & (F.trim(F.coalesce("note", F.lit(""))) == ""), "note_required")
    )
    return decisions.withColumns({"error": error, "is_valid": error.isNull()})


def stale_pending(decisions: DataFrame, asof: Column) -> DataFrame:
    """Unfinished classifications past their window."""
    pending = decisions.filter("reason_code = 'R-PENDING'")
    return pending.withColumn("is_stale", times.pending_stale(times.parse_iso(F.col("ts")), asof))


def release_intake(rows: DataFrame, body: str = "body") -> DataFrame:
    """Release verdict documents checked key by key; `errors` is empty for a valid one."""
    b = F.col(body)
    parsed = F.try_parse_json(b).isNotNull() & F.rlike(F.trim(b), F.lit(r"^\{"))
    keys = F.json_object_keys(b)
    need = F.array(*[F.lit(k) for k in vocab.RELEASE_KEYS])
    issues = F.from_json(
        F.get_json_object(b, "$.blocking_issues"), f"array<struct<{','.join(k + ':string' for k in vocab.BLOCKER_KEYS)}>>"
    )
    bad_issue = F.exists(
        issues,
        lambda i: reduce(lambda x, y: x | y, [i[k].isNull() for k in vocab.BLOCKER_KEYS])
        | ~F.coalesce(i["severity"], F.lit("")).isin(*vocab.RELEASE_RISKS),
    )
    missing = F.array_except(need, F.coalesce(keys, F.expr("cast(array() as array<string>)")))
    extra = F.array_except(F.coalesce(keys, F.expr("cast(array() as array<string>)")), need)
    errors = F.array_compact(
        F.array(
            F.when(~parsed, "not_json"),
            F.when(parsed & (F.size(missing) > 0), F.concat(F.lit("missing:"), F.array_join(F.array_sort(missing), ","))),
            F.when(parsed & (F.size(extra) > 0), F.concat(F.lit("unexpected:"), F.array_join(F.array_sort(extra), ","))),
            F.when(parsed & ~F.coalesce(F.get_json_object(b, "$.decision").isin(*vocab.RELEASE_DECISIONS), F.lit(False)), "decision"),
            F.when(parsed & ~F.coalesce(F.get_json_object(b, "$.risk_level").isin(*vocab.RELEASE_RISKS), F.lit(False)), "risk_level"),
            F.when(parsed & F.coalesce(bad_issue, F.lit(False)), "blocking_issues"),
        )
    )
    return rows.withColumns({"errors": errors, "is_valid": F.size(errors) == 0})


def jury_intake(rows: DataFrame, body: str = "body") -> DataFrame:
    """Jury documents checked against their closed vocabularies and bounds."""
    b = F.col(body)
    field = lambda n: F.get_json_object(b, f"$.{n}")
    cats = F.from_json(field("pii_categories"), "array<string>")
    tokens = F.from_json(field("example_tokens"), "array<string>")
    conf = field("confidence").try_cast("double")
    errors = F.array_compact(
        F.array(
            F.when(F.try_parse_json(b).isNull(), "not_json"),
            F.when(~F.coalesce(field("has_third_party_pii").isin("true", "false"), F.lit(False)), "has_third_party_pii"),
            F.when(cats.isNull() | F.exists(cats, lambda c: ~c.isin(*vocab.JURY_CATEGORIES)), "pii_categories"),
            F.when(F.coalesce(F.size(tokens), F.lit(0)) > 5, "example_tokens"),
            F.when(~F.coalesce(field("severity").isin(*vocab.JURY_SEVERITIES), F.lit(False)), "severity"),
            F.when(~F.coalesce(conf.between(0.0, 1.0), F.lit(False)), "confidence"),
            F.when(F.char_length(F.coalesce(field("rationale"), F.lit(""))) > 600, "rationale"),
        )
    )
    return rows.withColumns(
        {
            "has_third_party_pii": field("has_third_party_pii") == "true",
            "pii_categories": cats,
            "severity": field("severity"),
            "confidence": conf,
            "errors": errors,
            "is_valid": F.size(errors) == 0,
        }
    )


def prompt_provenance(verdicts: DataFrame, registry: DataFrame, effective: DataFrame, strict: bool = False) -> DataFrame:
    """Each verdict row checked against the registry of sealed prompts.

    verdicts: prompt_id, seal, strips (text), effective_sha256, malformed. registry: seal, prompt_id,
    version, is_current. effective: seal, strips, effective_sha256 (precomputed digests).
    """
    reg = registry.select("seal", F.col("prompt_id").alias("reg_id"), "version", "is_current")
    eff = effective.select("seal", "strips", F.col("effective_sha256").alias("expected"))
    rows = verdicts.join(reg, "seal", "left").join(eff, ["seal", "strips"], "left")
    status = (
        F.when(F.coalesce("malformed", F.lit(False)), "malformed")
        .when(F.coalesce("seal", F.lit("")) == "", "missing_seal")
        .when(F.col("reg_id").isNull(), "unknown_seal")
        .when(~F.col("prompt_id").eqNullSafe(F.col("reg_id")), "prompt_id_mismatch")
        .when(~F.col("effective_sha256").eqNullSafe(F.col("expected")), "effective_drift")
        .when(~F.col("is_current"), "older_version")
        .otherwise("ok")
    )
    level = F.when(status == "ok", "ok").when(status == "older_version", "error" if strict else "warning").otherwise("error")
    return rows.withColumns({"status": status, "level": level}).drop("reg_id", "expected")


def fitness_lookup(requests: DataFrame, reports: DataFrame, asof: Column, max_age_days: int = 30) -> DataFrame:
    """Newest fitness report for each request's parameters, or the reason there is none.

    requests: request_id, deployment_id, model_alias, primary_seal, recheck_seal, corpus_sha,
    params_sha. A report without a parameter digest is accepted; the recheck seal compares
    null-safely.
    """
    r = reports.select(
        "deployment_id", "model_alias",
        F.col("primary_seal").alias("r_primary"), F.col("recheck_seal").alias("r_recheck"),
        F.col("params_sha").alias("r_params"), F.col("corpus_sha").alias("r_corpus"),
        "report_id", "passed", "fails", times.parse_iso(F.col("generated_at")).alias("generated"),
    ).filter("generated is not null")
    match = (
        (F.col("q.deployment_id") == F.col("r.deployment_id"))
        & (F.col("q.model_alias") == F.col("r.model_alias"))
        & (F.col("q.primary_seal") == F.col("r.r_primary"))
        & F.col("q.recheck_seal").eqNullSafe(F.col("r.r_recheck"))
        & (F.col("r.r_params").isNull() | (F.col("r.r_params") == F.col("q.params_sha")))
    )
    best = (
        requests.alias("q").join(r.alias("r"), match, "inner")
        .groupBy("request_id")
        .agg(F.max_by(F.struct("report_id", "passed", "fails", "r_corpus", "generated"), F.struct("generated", "report_id")).alias("b"))
    )
    rows = requests.join(best, "request_id", "left")
    age = (F.unix_micros(asof) - F.unix_micros(F.col("b.generated"))) / F.lit(86_400e6)
    reason = (
        F.when(F.col("b").isNull(), "no_matching_report")
        .when(age > max_age_days, "stale")
        .when(~F.col("b.r_corpus").eqNullSafe(F.col("corpus_sha")), "corpus_drift")
        .when(~F.coalesce("b.passed", F.lit(False)), F.concat(F.lit("fitness_failed:"), F.coalesce(F.array_join("b.fails", ";"), F.lit("unknown"))))
    )
    return rows.select("request_id", F.when(reason.isNull(), F.col("b.report_id")).alias("report_id"), reason.alias("reason"))
