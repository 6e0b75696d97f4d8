"""Scope: prefilter, rerank, search, strata, verdict synthesis, fitness and recheck gating."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import stats, vocab
from .latest import first_per_key, latest_per_key


def scope_prefilter(embeddings: DataFrame, scopes: DataFrame, threshold: float = 0.30) -> DataFrame:
    """Cosine of every document with its case's scope vector.

    `scopes` has one row per case (case_id, scope_vector): an equi-join on the case, and
    Spark broadcasts it by itself when it is small enough. Vectors of another length are
    reported rather than scored.
    """
    joined = embeddings.join(scopes, "case_id", "inner")
    same = F.size("embedding") == F.size("scope_vector")
    score = F.when(same, stats.cosine(F.col("embedding"), F.col("scope_vector"))).otherwise(0.0)
    return joined.withColumn("cosine_score", score).select(
        "case_id",
        "ref",
        "cosine_score",
        F.when(~same, "dimension_mismatch")
        .when(F.col("cosine_score") >= threshold, "in_scope_candidate")
        .otherwise("not_relevant")
        .alias("verdict"),
        (same & (F.col("cosine_score") >= threshold)).alias("passes"),
        F.lit(threshold).alias("threshold"),
    )


def rerank(scored: DataFrame, threshold: float, mode: str = "shadow") -> DataFrame:
    """Drop decision per document from a scorer's output (case_id, ref, rerank_score).

    Only `enforce` removes rows; `shadow` records what would have been dropped.
    """
    if mode not in ("off", "shadow", "enforce"):
        raise ValueError(f"unknown rerank mode {mode!r}")
    if mode == "off":
        return scored.filter(F.lit(False)).withColumns({"would_drop": F.lit(False), "mode": F.lit(mode)})
    out = scored.withColumns({"would_drop": F.col("rerank_score") < threshold, "mode": F.lit(mode)})
    return out.filter(~F.col("would_drop")) if mode == "enforce" else out


def vector_search(
    embeddings: DataFrame, query: DataFrame, freshness: DataFrame | None = None, k: int = 10
) -> DataFrame:
    """Top k documents per query case by cosine; cases with stale embeddings return none.

    `query` is (case_id, scope_vector); `freshness` is (case_id, is_fresh).
    """
    if freshness is not None:
        query = query.join(freshness.filter("is_fresh").select("case_id"), "case_id", "left_semi")
    hits = embeddings.join(query, "case_id", "inner").filter(F.size("embedding") == F.size("scope_vector"))
    hits = hits.select("case_id", "ref", stats.cosine(F.col("embedding"), F.col("scope_vector")).alias("score"))
    best = Window.partitionBy("case_id").orderBy(F.desc("score"), "ref")
    return hits.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


def call_of(mapping: dict, column: Column, default: Column) -> Column:
    return stats.lookup(mapping, F.coalesce(column, F.lit("")), default)


def with_calls(rows: DataFrame) -> DataFrame:
    """Operator, primary and recheck verdicts as include / exclude / uncertain."""
    unsure = F.lit("uncertain")
    return rows.withColumns(
        {
            "operator_call": call_of(vocab.OPERATOR_TO_CALL, F.col("operator_verdict"), F.col("operator_verdict")),
            "primary_call": call_of(vocab.PRIMARY_TO_CALL, F.col("primary_verdict"), unsure),
            "recheck_call": call_of(vocab.RECHECK_TO_CALL, F.col("recheck_verdict"), unsure),
        }
    )


def verdict_strata(primary: DataFrame, recheck: DataFrame, register: DataFrame) -> DataFrame:
    """Registered documents with both verdicts and the calibration stratum they belong to."""
    p, r = F.col("primary_verdict"), F.col("recheck_verdict")
    excluded = p == "work_context_only"
    stratum = (
        F.when(excluded & (r == "reclassify_to_biographical"), "disputed_recheck_says_bio")
        .when(excluded & (r == "confirmed_work_context_only"), "agreed_work_context_only")
        .when(r == "reclassify_to_ambiguous", "recheck_ambiguous")
        .when(p == "biographical", "originally_biographical")
    )
    return (
        primary.select("case_id", "ref", "primary_verdict")
        .join(register.select("case_id", "ref"), ["case_id", "ref"], "left_semi")
        .join(recheck.select("case_id", "ref", "recheck_verdict"), ["case_id", "ref"], "left")
        .withColumn("stratum", stratum)
    )


def agreement_report(sample: DataFrame, decisions: DataFrame) -> DataFrame:
    """Per stratum and overall: sampled, decided, operator agrees with primary and with recheck."""
    last = latest_per_key(decisions, ["case_id", "ref"]).select(
        "case_id", "ref", F.col("verdict").alias("operator_verdict")
    )
    rows = with_calls(sample.join(last, ["case_id", "ref"], "left"))
    decided = F.col("operator_verdict").isNotNull()
    return (
        rows.groupingSets([["case_id", "stratum"], ["case_id"]], "case_id", "stratum")
        .agg(
            F.grouping("stratum").alias("is_total"),
            F.count(F.lit(1)).alias("sampled"),
            F.count_if(decided).alias("decided"),
            F.count_if(decided & (F.col("operator_call") == F.col("primary_call"))).alias("agree_primary"),
            F.count_if(decided & (F.col("operator_call") == F.col("recheck_call"))).alias("agree_recheck"),
        )
        .withColumn("stratum", F.when(F.col("is_total") == 1, "overall").otherwise(F.col("stratum")))
        .drop("is_total")
    )


def synthesise(
    primary: DataFrame, recheck: DataFrame, temporal: DataFrame, recheck_mode: str = "always"
) -> DataFrame:
    """Final scope verdict per document from primary verdict, recheck and time window.

    Inputs carry `seq`; a repeated ref takes its first row. A conflict between the content
    verdict and the time window is surfaced as ambiguous, never resolved silently. An
    unknown primary verdict is rejected: scope_verdict null, reason `unknown_primary`.
    """
    p = first_per_key(primary.select("case_id", "ref", "seq", "primary_verdict"), ["case_id", "ref"])
    r = first_per_key(
        recheck.select("case_id", "ref", "seq", "recheck_verdict", "error_code"), ["case_id", "ref"]
    )
    t = first_per_key(temporal.select("case_id", "ref", "seq", "temporal_verdict"), ["case_id", "ref"])
    rows = (
        p.drop("seq", "n_rows")
        .join(r.drop("seq", "n_rows"), ["case_id", "ref"], "left")
        .join(t.drop("seq", "n_rows"), ["case_id", "ref"], "left")
    )
    rows = rows.withColumn(
        "primary_scope", stats.lookup(vocab.PRIMARY_TO_SCOPE, F.lower(F.trim("primary_verdict")))
    )
    first, again, failed = F.col("primary_scope"), F.col("recheck_verdict"), F.col("error_code")
    off = recheck_mode == "never"
    reason = (
        F.when(first.isNull(), "unknown_primary")
        .when(first == "present", "primary_biographical")
        .when(first == "ambiguous", "primary_ambiguous")
        .when(failed.isNotNull(), F.concat(F.lit("recheck_errored:"), failed))
        .when(again == "confirmed_work_context_only", "recheck_confirms_wco")
        .when(again == "reclassify_to_biographical", "recheck_reclassified_biographical")
        .when(again == "reclassify_to_ambiguous", "recheck_reclassified_ambiguous")
        .when(again.isNull(), "primary_wco_recheck_disabled" if off else "recheck_expected_but_missing_for_ref")
        .otherwise(F.concat(F.lit("unknown_recheck_verdict:"), again))
    )
    rows = rows.withColumn("reason", reason)
    effective = (
        F.when(F.col("reason") == "unknown_primary", F.lit(None).cast("string"))
        .when(F.col("reason").isin("primary_biographical", "recheck_reclassified_biographical"), "present")
        .when(F.col("reason").isin("recheck_confirms_wco", "primary_wco_recheck_disabled"), "not_present")
        .otherwise("ambiguous")
    )
    rows = rows.withColumn("effective", effective)
    out_of_window = F.coalesce(F.col("temporal_verdict") == "out_of_scope", F.lit(False))
    eff, why = F.col("effective"), F.col("reason")
    scope = F.when(out_of_window & (eff == "present"), "ambiguous").otherwise(eff)
    note = (
        F.when(eff.isNull(), "primary verdict not recognised")
        .when(
            out_of_window & (eff == "present"),
            F.concat(F.lit("durant=present ("), why, F.lit(") vs temporal=out_of_scope; operator should reconcile")),
        )
        .when(out_of_window & (eff == "ambiguous"), F.concat(F.lit("durant=ambiguous ("), why, F.lit(") + temporal=out_of_scope")))
        .when(out_of_window, F.concat(F.lit("effective_durant=not_present ("), why, F.lit("); temporal=out_of_scope")))
        .when(eff == "ambiguous", F.concat(F.lit("effective_durant=ambiguous ("), why, F.lit("), temporal="), F.coalesce("temporal_verdict", F.lit("None"))))
        .otherwise(F.concat(F.lit("effective_durant="), eff, F.lit(" ("), why, F.lit(")")))
    )
    return rows.select(
        "case_id", "ref", "primary_scope", "recheck_verdict", "error_code", "temporal_verdict",
        "effective", "reason", scope.alias("scope_verdict"), note.alias("decision_rationale"),
    )


def synthesis_summary(verdicts: DataFrame) -> DataFrame:
    """Decision-flow counters of a synthesis pass, per case."""
    first, again, why = F.col("primary_scope"), F.col("recheck_verdict"), F.col("reason")
    out = F.coalesce(F.col("temporal_verdict") == "out_of_scope", F.lit(False))
    promoted = why == "recheck_reclassified_biographical"
    return verdicts.groupBy("case_id").agg(
        F.count_if(first == "present").alias("primary_present"),
        F.count_if(first == "not_present").alias("primary_not_present"),
        F.count_if(first == "ambiguous").alias("primary_ambiguous"),
        F.count_if(promoted).alias("recheck_promoted"),
        F.count_if(why == "recheck_reclassified_ambiguous").alias("recheck_escalated"),
        F.count_if(why == "recheck_confirms_wco").alias("recheck_confirmed"),
        F.count_if(F.startswith(why, F.lit("recheck_errored:"))).alias("recheck_errored"),
        F.count_if(why == "recheck_expected_but_missing_for_ref").alias("recheck_missing_anomaly"),
        F.count_if(why == "primary_wco_recheck_disabled").alias("primary_wco_recheck_disabled"),
        F.count_if(F.startswith(why, F.lit("unknown_recheck_verdict:"))).alias("recheck_other"),
        F.count_if(F.col("scope_verdict") == "present").alias("scope_present"),
        F.count_if(F.col("scope_verdict") == "not_present").alias("scope_not_present"),
        F.count_if(F.col("scope_verdict") == "ambiguous").alias("scope_ambiguous"),
        F.count_if(out).alias("temporal_out_blocked"),
        F.count_if(out & promoted).alias("temporal_recheck_conflict"),
    )


def recheck_summary(recheck: DataFrame, mode: str = "always") -> DataFrame:
    """Outcome counts of a recheck pass, per case."""
    ok = F.col("error_code").isNull()
    v = F.col("recheck_verdict")
    return recheck.groupBy("case_id").agg(
        F.lit(mode).alias("mode_effective"),
        F.count(F.lit(1)).alias("docs_examined"),
        F.count_if(ok & (v == "reclassify_to_biographical")).alias("docs_reclassified_to_biographical"),
        F.count_if(ok & (v == "reclassify_to_ambiguous")).alias("docs_reclassified_to_ambiguous"),
        F.count_if(ok & (v == "confirmed_work_context_only")).alias("docs_confirmed_wco"),
        F.count_if(~ok).alias("errors"),
    )


def fitness_report(results: DataFrame, keys: list[str], criteria: dict | None = None) -> DataFrame:
    """Fitness of a model on a labelled set (truth, gate, error_code), with pass or fail codes.

    Class sizes count every labelled row; rates count successful rows only. A rate with
    nothing to divide by is null and raises no code of its own.
    """
    c = vocab.FITNESS_CRITERIA | (criteria or {})
    truth, gate, ok = F.col("truth"), F.col("gate"), F.col("error_code").isNull()
    bio, wco = truth == "biographical", truth == "work_context_only"
    counts = results.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("corpus_size"),
        F.count_if(bio).alias("n_biographical_truth"),
        F.count_if(wco).alias("n_work_context_only_truth"),
        F.count_if(truth == "ambiguous").alias("n_ambiguous_truth"),
        F.count_if(ok).alias("n_successful"),
        F.count_if(ok & bio).alias("n_biographical_successful"),
        F.count_if(ok & wco).alias("n_work_context_only_successful"),
        F.count_if(~ok).alias("n_errored"),
        F.count_if(ok & (gate == truth)).alias("n_agree"),
        F.count_if(ok & bio & (gate == "work_context_only")).alias("n_fn"),
        F.count_if(ok & wco & (gate == "biographical")).alias("n_fp"),
        F.count_if(ok & (bio | wco) & (gate == "ambiguous")).alias("n_ambiguous_on_definite"),
    )
    n = F.col
    definite = n("n_biographical_successful") + n("n_work_context_only_successful")
    rates = counts.withColumns(
        {
            "success_rate": stats.rate(n("n_successful"), n("corpus_size")),
            "agreement": stats.rate(n("n_agree"), n("n_successful")),
            "agreement_wilson_lower": stats.wilson(n("n_agree"), n("n_successful"))[0],
            "fn_rate": stats.rate(n("n_fn"), n("n_biographical_successful")),
            "fn_rate_wilson_upper": stats.wilson(n("n_fn"), n("n_biographical_successful"))[1],
            "fp_rate": stats.rate(n("n_fp"), n("n_work_context_only_successful")),
            "fp_rate_wilson_upper": stats.wilson(n("n_fp"), n("n_work_context_only_successful"))[1],
            "ambiguous_rate_on_definite_truth": stats.rate(n("n_ambiguous_on_definite"), definite),
        }
    )
    low = c["min_class_eligible"]
    checks = [(n("corpus_size") < c["required_corpus_min_size"], "corpus:corpus_size_below_minimum")]
    for cls in ("biographical", "work_context_only"):
        size, done = n(f"n_{cls}_truth"), n(f"n_{cls}_successful")
        checks.append((size < low, f"corpus:corpus_{cls}_class_below_minimum"))
        checks.append(((size >= low) & (done == 0), f"model:{cls}_class_all_errored"))
    checks += [
        (n("success_rate") < c["min_success_rate"], "model:success_rate_below_minimum"),
        (n("agreement_wilson_lower") < c["min_agreement"], "model:agreement_wilson_lower_below_threshold"),
        (n("fn_rate_wilson_upper") > c["max_fn_rate"], "model:fn_wilson_upper_above_threshold"),
        (n("fp_rate_wilson_upper") > c["max_fp_rate"], "model:fp_wilson_upper_above_threshold"),
        (n("ambiguous_rate_on_definite_truth") > c["max_ambiguous_ratio"], "model:ambiguous_rate_above_threshold"),
    ]
    fails = F.array_compact(F.array(*[F.when(bad, code) for bad, code in checks]))
    return rates.withColumn("fails", fails).withColumn("passed", F.size("fails") == 0)


def recheck_gate(
    requests: DataFrame, registry: DataFrame, asof: Column, fn_threshold: float = 0.10, max_age_days: int = 90
) -> DataFrame:
    """Whether the recheck may be skipped, per request.

    `requests`: request_id, mode (always / never / auto), deployment_id, model_alias,
    primary_seal, recheck_seal. `registry`: the calibration entries. Only a fresh entry for the
    same prompts whose upper bound is at or under the threshold lets the recheck be skipped.
    Entries are matched on deployment, model and both seals; ties go to the newest, then the largest
    sample. Only if none matches all four does an entry for other prompts count as drift.
    """
    rank = F.struct("calibrated_at", "sample_size", F.coalesce("source_case_id", F.lit("")))
    entry = F.struct("calibrated_at", "entry_primary_seal", "entry_recheck_seal", "ci_lower", "ci_upper", "sample_size")
    valid = (
        registry.filter("ci_lower between 0 and 1 and ci_upper between 0 and 1 and ci_lower <= ci_upper")
        .filter("fn_rate between ci_lower and ci_upper")
        .withColumns(
            {
                "entry_primary_seal": F.lower(F.trim("primary_seal")),
                "entry_recheck_seal": F.lower(F.trim("recheck_seal")),
            }
        )
    )
    seals = ["entry_primary_seal", "entry_recheck_seal"]
    exact = valid.groupBy("deployment_id", "model_alias", *seals).agg(F.max_by(entry, rank).alias("exact"))
    other = valid.groupBy("deployment_id", "model_alias").agg(F.max_by(entry, rank).alias("other"))
    asked = requests.withColumns({s: F.lower(F.trim(s.removeprefix("entry_"))) for s in seals})
    same = F.lit(True)
    for name in ("deployment_id", "model_alias", *seals):
        same = same & F.col(f"q.{name}").eqNullSafe(F.col(f"x.{name}"))
    rows = (
        asked.alias("q").join(exact.alias("x"), same, "left").select("q.*", "exact")
        .join(other, ["deployment_id", "model_alias"], "left")
        .withColumn("e", F.coalesce("exact", "other"))
    )
    age = (F.unix_micros(asof) - F.unix_micros(F.col("e.calibrated_at"))) / F.lit(86_400e6)
    drift = F.col("exact").isNull()
    reason = (
        F.when(F.col("mode").isin("always", "never"), "mode_set_explicit")
        .when(F.col("e").isNull(), "calibration_cache_miss")
        .when(age > max_age_days, "calibration_stale")
        .when(drift, "calibration_prompt_seal_drift")
        .when(F.col("e.ci_upper") > fn_threshold, "ci_upper_above_threshold")
        .otherwise("ci_upper_below_threshold")
    )
    skip = (F.col("mode") == "never") | (F.col("reason") == "ci_upper_below_threshold")
    return rows.withColumn("reason", reason).select(
        "request_id",
        F.col("mode").alias("mode_requested"),
        F.when(skip, "never").otherwise("always").alias("mode_effective"),
        "reason",
        F.col("e.ci_upper").alias("ci_upper"),
    )


def model_cost(calls: DataFrame, prices: DataFrame) -> DataFrame:
    """Cost per case and stage; a call with an unpriced model has no cost and is counted."""
    priced = calls.join(prices, "model_alias", "left").withColumn(
        "cost",
        F.col("input_tokens") * F.col("in_per_1k") / 1000 + F.col("output_tokens") * F.col("out_per_1k") / 1000,
    )
    return priced.groupBy("case_id", "stage").agg(
        F.count(F.lit(1)).alias("calls"),
        F.count_if(F.col("cost").isNull()).alias("unpriced_calls"),
        F.round(F.sum("cost"), 6).alias("cost_usd"),
    )


def tag_scope(documents: DataFrame, verdicts: DataFrame, dispositions: DataFrame) -> DataFrame:
    """Documents to tag: scope verdict present or ambiguous; a case without any verdict falls
    back to documents whose disposition is `included`."""
    with_verdicts = verdicts.select("case_id").distinct()
    wanted = (
        verdicts.filter(F.col("scope_verdict").isin(*vocab.TAG_SCOPE)).select("case_id", "ref")
    ).unionByName(
        dispositions.filter("disposition = 'included'").select("case_id", "ref").join(with_verdicts, "case_id", "left_anti")
    )
    return documents.join(wanted.distinct(), ["case_id", "ref"], "left_semi")


def scope_discrepancies(verdicts: DataFrame, dispositions: DataFrame) -> DataFrame:
    """Documents in scope by verdict that were nevertheless excluded."""
    in_scope = verdicts.filter(F.col("scope_verdict").isin(*vocab.TAG_SCOPE)).select("case_id", "ref")
    return in_scope.intersect(dispositions.filter("disposition = 'excluded'").select("case_id", "ref"))


def pending_work(documents: DataFrame, done: DataFrame, retry_errors: bool = True) -> DataFrame:
    """Documents still to be processed; rows that ended in an error are tried again."""
    finished = done.filter(F.col("error_state").isNull()) if retry_errors else done
    return documents.join(finished.select("case_id", "ref"), ["case_id", "ref"], "left_anti")


def refs_of_paths(ingested: DataFrame, register: DataFrame) -> DataFrame:
    """Ingested items under the ref their path is registered with."""
    return ingested.join(register.select("case_id", "path", "ref"), ["case_id", "path"], "inner")
