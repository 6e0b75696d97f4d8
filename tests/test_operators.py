"""Operators on small golden tables, with brute force where the logic is not plain."""

import hashlib
import random
import statistics
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from caseweave.functions import replies, times, vocab
from caseweave.operators import (
    dedupe, entities, integrity, latest, metrics, ordered, people, quality, redaction, review, sampling, scope, scorers,
)


def rows(df, *cols):
    return sorted([tuple(r[c] for c in cols) for r in df.collect()], key=repr)


def asof():
    return F.to_timestamp(F.lit("2024-06-30 12:00:00"))

# ---- logs ------------------------------------------------------------------


def test_latest_and_first_win_whatever_the_order(spark):
    log = [("c", "a", 3, "x"), ("c", "a", 7, "y"), ("c", "b", 1, "z"), ("c", "", 9, "q"), ("c", None, 9, "q")]
    df = spark.createDataFrame(random.Random(1).sample(log, len(log)), "case_id string, ref string, seq int, decision string").repartition(5)
    assert rows(latest.latest_per_key(df, ["case_id", "ref"]), "ref", "decision", "n_rows") == [("a", "y", 2), ("b", "z", 1)]
    assert rows(latest.first_per_key(df, ["case_id", "ref"]), "ref", "decision") == [("a", "x"), ("b", "z")]


def test_recent_kinds_newest_first(spark):
    df = spark.createDataFrame([("c", i, k) for i, k in enumerate(["a", "", "b", "c", None, "d"])], "case_id string, seq int, stage string")
    assert latest.recent_kinds(df).first().recent == ["d", "c", "b"]


# ---- ordered ---------------------------------------------------------------


def skewed(n=3000, seed=3):
    rng = random.Random(seed)
    return [("hot" if i % 3 else f"k{i % 11}", i, 0 if rng.random() < 0.5 else rng.randint(0, 40)) for i in range(n)]


def test_global_rank_equals_sorting(spark):
    data = skewed()
    df = spark.createDataFrame(data, "k string, id int, score int").repartition(7).withColumn("h", F.sha2(F.col("id").cast("string"), 256))
    got = ordered.global_rank(df, ["k"], [(F.col("score"), True), (F.substring("h", 1, 2), False)], [F.col("h")], total="n")
    want = {}
    for key in {d[0] for d in data}:
        group = sorted((-s, hashlib.sha256(str(i).encode()).hexdigest(), i) for k, i, s in data if k == key)
        want.update({i: (r, len(group)) for r, (_, _, i) in enumerate(group, 1)})
    assert {r.id: (r["rank"], r.n) for r in got.collect()} == want


def test_linked_is_a_lag(spark):
    rng = random.Random(5)
    data = sorted({(rng.choice("ab"), rng.randint(0, 5000)) for _ in range(1500)})
    df = spark.createDataFrame([(k, s, s * 2) for k, s in data], "k string, seq int, v int").repartition(6)
    got = {(r.k, r.seq): r.prev_v for r in ordered.linked(df, ["k"], "seq", ["v"], width=100).collect()}
    for key in "ab":
        seqs = [s for k, s in data if k == key]
        assert [got[(key, s)] for s in seqs] == [None] + [s * 2 for s in seqs[:-1]]


@pytest.mark.parametrize("values", [[1.0], [1.0, 2.0], [0.0] * 700 + [5.5, 9.1], [x / 7 for x in range(501)], [3.2, 1.1, 1.1, 7.7]])
def test_exact_median(spark, values):
    df = spark.createDataFrame([("g", v) for v in values], "g string, v double")
    got = ordered.exact_median(df, ["g"], "v", F.floor("v")).first()["median"]
    assert got == pytest.approx(statistics.median(values))


@pytest.mark.parametrize("extra", [0, 1, 40_000], ids=["even", "odd", "tie"])
def test_exact_median_of_values_crowded_into_one_bucket(spark, extra):
    rng = random.Random(extra)
    crowded = [rng.random() ** 9 for _ in range(20_000)] + [0.001] * extra
    data = [("hot", v) for v in crowded] + [("far", 5.0), ("far", -3.0), ("gone", None)]
    df = spark.createDataFrame(data, "g string, v double").repartition(6)
    got = {r.g: r["median"] for r in ordered.exact_median(df, ["g"], "v", F.floor("v"), most=200).collect()}
    assert got == {"hot": pytest.approx(statistics.median(crowded), rel=1e-12), "far": 1.0}
    walked = ordered.middle_values(df, ["g"], "v", F.floor("v"), most=200).groupBy("g", "_b").count()
    assert walked.agg(F.max("count")).first()[0] <= 200


def test_exact_median_of_nothing(spark):
    df = spark.createDataFrame([("g", None)], "g string, v double")
    assert ordered.exact_median(df, ["g"], "v", F.floor("v")).count() == 0


# ---- duplicates ------------------------------------------------------------


def test_dedupe_prefers_message_id_and_reuses_one_exchange(spark):
    data = [("c", "d3", "h1", None), ("c", "d1", "h1", ""), ("c", "d2", "h2", "m1"), ("c", "d9", "h3", "m1"), ("e", "d1", "h1", None)]
    df = spark.createDataFrame(data, "case_id string, ref string, hash string, mid string")
    found = dedupe.mark_duplicates(df, F.col("mid"))
    assert rows(found, "case_id", "ref", "dedupe_verdict", "dedupe_basis") == [
        ("c", "d1", "canonical", "sha256"), ("c", "d2", "canonical", "message_id"), ("c", "d3", "duplicate", "sha256"),
        ("c", "d9", "duplicate", "message_id"), ("e", "d1", "canonical", "sha256"),
    ]
    found.collect()
    found._jdf.queryExecution().executedPlan()


def test_keep_canonical_falls_back_to_everything(spark):
    docs = spark.createDataFrame([("a", "1"), ("a", "2"), ("b", "1"), ("z", "1")], "case_id string, ref string")
    findings = spark.createDataFrame([("a", "1", "canonical"), ("a", "2", "duplicate"), ("b", "1", "duplicate")], "case_id string, ref string, dedupe_verdict string")
    assert rows(dedupe.keep_canonical(docs, findings), "case_id", "ref") == [("a", "1"), ("b", "1"), ("z", "1")]
    assert dedupe.keep_canonical(docs, findings, True).count() == 4
    status = {r.case_id: (r["mode"], r.skipped, r.warning != "") for r in dedupe.filter_status(docs, findings).collect()}
    assert status == {"a": ("canonical_only", 1, False), "b": ("no_filter", 0, True), "z": ("no_filter", 0, False)}


# ---- scope -----------------------------------------------------------------


def test_prefilter_reports_wrong_length_and_zero_vectors(spark):
    emb = spark.createDataFrame([("c", "a", [1.0, 0.0]), ("c", "b", [1.0]), ("c", "z", [0.0, 0.0])], "case_id string, ref string, embedding array<float>")
    sc = spark.createDataFrame([("c", [2.0, 0.0])], "case_id string, scope_vector array<float>")
    got = {r.ref: (r.verdict, r.cosine_score, r.passes) for r in scope.scope_prefilter(emb, sc, 1.0).collect()}
    assert got == {"a": ("in_scope_candidate", 1.0, True), "b": ("dimension_mismatch", 0.0, False), "z": ("not_relevant", 0.0, False)}


def test_vector_search_refuses_stale_cases(spark):
    emb = spark.createDataFrame([("c", f"d{i}", [1.0, float(i)]) for i in range(5)] + [("s", "x", [1.0, 0.0])], "case_id string, ref string, embedding array<float>")
    q = spark.createDataFrame([("c", [1.0, 0.0]), ("s", [1.0, 0.0])], "case_id string, scope_vector array<float>")
    fresh = spark.createDataFrame([("c", True), ("s", False)], "case_id string, is_fresh boolean")
    got = scope.vector_search(emb, q, fresh, 2).orderBy("rank").collect()
    assert [(r.case_id, r.ref) for r in got] == [("c", "d0"), ("c", "d1")]


DECISIONS = [
    ("biographical", None, None, "always", None, "present", "primary_biographical"),
    ("ambiguous", None, None, "always", None, "ambiguous", "primary_ambiguous"),
    ("work_context_only", None, "timeout", "always", None, "ambiguous", "recheck_errored:timeout"),
    ("work_context_only", "reclassify_to_biographical", "bad", "always", None, "ambiguous", "recheck_errored:bad"),
    ("work_context_only", "confirmed_work_context_only", None, "always", None, "not_present", "recheck_confirms_wco"),
    ("work_context_only", "reclassify_to_biographical", None, "always", None, "present", "recheck_reclassified_biographical"),
    ("work_context_only", "reclassify_to_ambiguous", None, "always", None, "ambiguous", "recheck_reclassified_ambiguous"),
    ("work_context_only", None, None, "never", None, "not_present", "primary_wco_recheck_disabled"),
    ("work_context_only", None, None, "always", None, "ambiguous", "recheck_expected_but_missing_for_ref"),
    ("work_context_only", "future", None, "always", None, "ambiguous", "unknown_recheck_verdict:future"),
    (" Biographical ", None, None, "always", "out_of_scope", "ambiguous", "primary_biographical"),
    ("ambiguous", None, None, "always", "out_of_scope", "ambiguous", "primary_ambiguous"),
    ("not_present", None, None, "never", "out_of_scope", "not_present", "primary_wco_recheck_disabled"),
    ("present", None, None, "always", "in_scope", "present", "primary_biographical"),
    ("nonsense", None, None, "always", None, None, "unknown_primary"),
]


@pytest.mark.parametrize("mode", ["always", "never"])
def test_synthesis_table(spark, mode):
    cases = [(f"d{i}", *c) for i, c in enumerate(DECISIONS) if c[3] == mode]
    primary = spark.createDataFrame([("c", d, 1, p) for d, p, *_ in cases], "case_id string, ref string, seq int, primary_verdict string")
    again = [("c", d, 1, r, e) for d, _, r, e, *_ in cases if r or e]
    recheck = spark.createDataFrame(again, "case_id string, ref string, seq int, recheck_verdict string, error_code string")
    temporal = spark.createDataFrame([("c", d, 1, t) for d, _, _, _, _, t, *_ in cases if t], "case_id string, ref string, seq int, temporal_verdict string")
    got = {r.ref: (r.scope_verdict, r.reason) for r in scope.synthesise(primary, recheck, temporal, mode).collect()}
    assert got == {c[0]: (c[6], c[7]) for c in cases}
    summary = scope.synthesis_summary(scope.synthesise(primary, recheck, temporal, mode)).first()
    assert summary.scope_present + summary.scope_not_present + summary.scope_ambiguous == sum(c[6] is not None for c in cases)


def test_synthesis_takes_the_first_row_of_a_ref(spark):
    primary = spark.createDataFrame([("c", "d", 2, "ambiguous"), ("c", "d", 1, "biographical")], "case_id string, ref string, seq int, primary_verdict string")
    none = spark.createDataFrame([], "case_id string, ref string, seq int, recheck_verdict string, error_code string")
    temporal = spark.createDataFrame([], "case_id string, ref string, seq int, temporal_verdict string")
    assert scope.synthesise(primary, none, temporal).first().scope_verdict == "present"


def test_fitness_codes(spark):
    perfect = [("p", "biographical", "biographical", None)] * 12 + [("p", "work_context_only", "work_context_only", None)] * 18
    one_fn = perfect[1:] + [("p", "biographical", "work_context_only", None)]
    errored = [("p", "biographical", None, "timeout")] * 12 + perfect[12:]
    named = [(n, *r[1:]) for n, rs in (("perfect", perfect), ("one_fn", one_fn), ("errored", errored), ("tiny", perfect[:3])) for r in rs]
    df = spark.createDataFrame(named, "m string, truth string, gate string, error_code string")
    got = {r.m: (r.passed, set(r.fails)) for r in scope.fitness_report(df, ["m"]).collect()}
    assert got["perfect"] == (True, set())
    assert got["one_fn"] == (False, {"model:fn_wilson_upper_above_threshold"})
    assert got["errored"][1] == {"model:biographical_class_all_errored", "model:success_rate_below_minimum"}
    assert "corpus:corpus_size_below_minimum" in got["tiny"][1]
    assert {r.m: r.fn_rate for r in scope.fitness_report(df, ["m"]).collect()}["errored"] is None


def test_recheck_gate_reasons(spark):
    reqs = [("a", "always", "d1"), ("n", "never", "d1"), ("miss", "auto", "none"), ("old", "auto", "d2"), ("drift", "auto", "d3"), ("high", "auto", "d4"), ("ok", "auto", "d1")]
    req = spark.createDataFrame([(i, m, d, "m", " AB ", "r") for i, m, d in reqs], "request_id string, mode string, deployment_id string, model_alias string, primary_seal string, recheck_seal string")
    t = lambda s: datetime.fromisoformat(s)
    reg = spark.createDataFrame(
        [("d1", "m", "ab", "R", t("2024-06-01"), 10, "s", 0.05, 0.0, 0.10), ("d1", "m", "ab", "R", t("2024-05-01"), 99, "s", 0.5, 0.4, 0.9),
         ("d1", "m", "ab", "R", t("2024-06-20"), 10, "s", 0.5, 0.6, 0.4), ("d2", "m", "ab", "r", t("2023-01-01"), 10, "s", 0.0, 0.0, 0.05),
         ("d3", "m", "zz", "r", t("2024-06-01"), 10, "s", 0.0, 0.0, 0.05), ("d4", "m", "ab", "r", t("2024-06-01"), 10, "s", 0.1, 0.0, 0.11)],
        "deployment_id string, model_alias string, primary_seal string, recheck_seal string, calibrated_at timestamp, sample_size int, source_case_id string, fn_rate double, ci_lower double, ci_upper double",
    )
    newer = spark.createDataFrame([("d1", "m", "other", "r", t("2024-06-25"), 10, "s", 0.05, 0.0, 0.10)], reg.schema)
    got = {r.request_id: (r.mode_effective, r.reason) for r in scope.recheck_gate(req, reg.union(newer), asof()).collect()}
    assert got == {
        "a": ("always", "mode_set_explicit"), "n": ("never", "mode_set_explicit"), "miss": ("always", "calibration_cache_miss"),
        "old": ("always", "calibration_stale"), "drift": ("always", "calibration_prompt_seal_drift"),
        "high": ("always", "ci_upper_above_threshold"), "ok": ("never", "ci_upper_below_threshold"),
    }


def test_replies(spark):
    texts = [("ok", '```json\n{"durant_verdict": "biographical", "rationale": "r"}\n```', True), ("odd", 'x {"durant_verdict": "yes"} y', True),
             ("bad", "{not json}", True), ("empty", "  ", True), ("none", None, False), ("plain", "no object", True)]
    df = spark.createDataFrame(texts, "i string, reply string, reachable boolean")
    got = {r.i: tuple(r.p) for r in df.select("i", replies.primary_row(F.col("reply"), F.col("reachable")).alias("p")).collect()}
    assert got["ok"] == ("biographical", "r", None) and got["odd"][0] == "ambiguous" and got["odd"][2] is None
    assert [got[k][2] for k in ("bad", "empty", "none", "plain")] == ["schema_validation_failed", "empty_response", "model_unreachable", "schema_validation_failed"]
    again = {r.i: r.p.recheck_verdict for r in df.select("i", replies.recheck_row(F.col("reply"), F.col("reachable")).alias("p")).collect()}
    assert set(again.values()) == {"reclassify_to_ambiguous"}
    notes = spark.createDataFrame([('LEAK_TERMS=["a", "b c"]\nrest',), ("none",), ('LEAK_TERMS=["é"]',)], "n string")
    assert [r.t for r in notes.select(replies.leak_terms(F.col("n")).alias("t")).collect()] == [["a", "b c"], None, ["é"]]


def test_error_objects_are_trimmed(spark):
    bodies = ['{"code": "timeout", "message": "' + "m" * 600 + '", "raw": "secret"}', '{"code": 5}', '"text"', "[1]", "{bad", None]
    got = [r.e for r in spark.createDataFrame([(b,) for b in bodies], "b string").select(replies.trim_error(F.col("b")).alias("e")).collect()]
    assert got[0].code == "timeout" and len(got[0].message) == 400 and got[0].message.endswith("…")
    assert tuple(got[1]) == ("5", None) and got[2:] == [None] * 4


def test_signature_people(spark):
    text = "Hello\nPrint Name: ____ Ann Lee\nx\n\n_______\nBob Ray\nThanks\nCarla Möller-Diaz\nbye now\nAnn Lee"
    docs = spark.createDataFrame([("c", "d", text)], "case_id string, ref string, text string")
    got = {r.display_name: (r.origin, r.confidence) for r in people.signature_people(docs).collect()}
    assert got == {"Ann Lee": ("anchored", 0.9), "Bob Ray": ("last_lines", 0.5), "Carla Möller-Diaz": ("last_lines", 0.5)}


def test_anonymised_text_keeps_the_subject(spark):
    ents = [(0, 3, "Bob", "person", "m", "third_party", "redact"), (4, 7, "Eve", "person", "m", "data_subject", "preserve"), (8, 13, "a@b.c", "email", "r", "third_party", "redact"), (14, 17, "bob", "person", "m", "third_party", "flag")]
    schema = "case_id string, ref string, entities array<struct<start:int,end:int,text:string,type:string,source:string,classification:string,redact:string>>"
    docs = spark.createDataFrame([("c", "d", "Bob Eve a@b.c bob"), ("c", "e", "nothing")], "case_id string, ref string, text string")
    labels = spark.createDataFrame([("c", "bob", "PERSON_C1")], "case_id string, name string, label string")
    got = {r.ref: r.anonymised for r in redaction.anonymise(docs, spark.createDataFrame([("c", "d", ents)], schema), labels).collect()}
    assert got == {"d": "[PERSON_C1] Eve [EMAIL] [PERSON_C1]", "e": "nothing"}


def test_scorer_contract(spark):
    docs = spark.createDataFrame([("c", "a", "x"), ("c", "b", "y")], "case_id string, ref string, text string")
    with pytest.raises(Exception, match="empty vector"):
        scorers.embed(docs, lambda: lambda ts: [[] for _ in ts]).collect()
    with pytest.raises(Exception, match="vectors for"):
        scorers.embed(docs, lambda: lambda ts: []).collect()
    found = scorers.findings(docs, lambda: lambda ts: [[{"stage": 1, "surface": t, "type": "k", "detector": "d", "confidence": 0.5}] * 2 if t == "x" else [] for t in ts])
    grouped = entities.findings_by_ref(found).collect()
    assert [(r.ref, r.n_findings) for r in grouped] == [("a", 2)]


def test_scorers_get_texts_in_slices_of_bounded_size(spark):
    """However large Arrow's batch is, a call gets little more text than the bound; long texts stay whole, and nulls reach the scorer."""
    schema = "case_id string, ref string, scope_text string, text string"
    texts = ["x" * 40_000] * 90 + ["é" * 3_000_000, None, ""]
    pairs = spark.createDataFrame([("c", f"d{i:02d}", "s" * 10_000, t) for i, t in enumerate(texts)], schema).coalesce(1)

    def make():
        size = lambda s, t: sum(len(x or "") for x in [*s, *t])
        return lambda scopes, texts: [float(size(scopes, texts))] * len(texts)

    got = {r.ref: r.rerank_score for r in scorers.rerank_scores(pairs, make).collect()}
    assert len(got) == len(texts) and got["d90"] == 3_010_000
    assert max(v for k, v in got.items() if k != "d90") <= 1 << 20
    lengths = scorers.chat(pairs.withColumnRenamed("text", "prompt"), lambda: lambda ps: [p and str(len(p)) for p in ps]).collect()
    assert {r.ref: (r.reply, r.reachable) for r in lengths if r.ref > "d88"} == {
        "d89": ("40000", True), "d90": ("3000000", True), "d91": (None, False), "d92": ("", True)
    }
    vectors = scorers.embed(pairs.filter("text is not null"), lambda: lambda ts: [[float(len(t)), 1.0] for t in ts]).collect()
    assert [list(r.embedding) for r in vectors if r.ref > "d89"] == [[3000000.0, 1.0], [0.0, 1.0]]


# ---- entities --------------------------------------------------------------


def test_tags_classification_order_and_dedupe(spark):
    subject = spark.createDataFrame(
        [("c", "Jane Roe", ["JR One"], "jane@x.org", [], ["Acme Ltd", ""])],
        "case_id string, full_name string, aliases array<string>, email string, additional_emails array<string>, subject_protected_phrases array<string>",
    )
    text = "Jane met BOB Smith at Acme; bob smith wrote to jane@x.org and bob@y.org. Globex GLOBEX."
    found = [("Bob Smith", "person", "third_party"), ("Acme", "organisation", "organisation"), ("Globex", "organisation", "organisation"),
             ("Globex", "organisation", "third_party"), ("x", "person", "third_party"), ("Roe", "person", "third_party"), ("met", "other", "weird"), ("bob@y.org", "id", "uncertain")]
    docs = spark.createDataFrame([("c", "d", text)], "case_id string, ref string, text string")
    model = spark.createDataFrame([("c", "d", found)], "case_id string, ref string, found array<struct<text:string,type:string,classification:string>>")
    tags = entities.build_tags(docs, entities.subject_identifiers(subject), model)
    row = tags.first()
    got = [(e.text, e.start, e.source, e.classification, e.redact) for e in row.entities]
    assert got == [
        ("Bob Smith", 9, "model", "third_party", "redact"), ("Bob Smith", 28, "model", "third_party", "redact"),
        ("Acme", 22, "model", "data_subject", "preserve"), ("Globex", 73, "model", "organisation", "flag"), ("Globex", 80, "model", "organisation", "flag"),
        ("met", 5, "model", "unknown", "flag"), ("bob@y.org", 62, "model", "unknown", "flag"), ("jane@x.org", 47, "regex", "data_subject", "preserve"),
    ]
    assert (row.entity_count, row.redact_count, row.flag_count) == (8, 2, 4)


def test_flag_resolution_latest_and_instance_first(spark):
    ent = spark.createDataFrame(
        [("c", "d1", 0, 3, "Foo", "organisation", "flag"), ("c", "d2", 0, 3, "Foo", "organisation", "flag"), ("c", "d1", 9, 12, "Foo", "unknown", "flag"), ("c", "d1", 20, 23, "Foo", "organisation", "redact")],
        "case_id string, ref string, start int, end int, text string, classification string, redact string",
    )
    dec = spark.createDataFrame(
        [("c", 1, "cluster", "Foo", "organisation", None, None, None, "redact"), ("c", 2, "cluster", "Foo", "organisation", None, None, None, "preserve"),
         ("c", 3, "cluster", "Foo", "organisation", None, None, None, "escalate"), ("c", 4, "instance", "Foo", "organisation", "d2", 0, 3, "redact"),
         ("c", 5, "instance", "Foo", "organisation", "d2", 1, 3, "redact")],
        "case_id string, seq int, scope string, text string, classification string, ref string, start int, end int, verdict string",
    )
    assert rows(redaction.resolve_flags(ent, dec), "ref", "start", "redact") == [("d1", 0, "preserve"), ("d1", 20, "redact"), ("d1", 9, "flag"), ("d2", 0, "redact")]
    assert rows(redaction.stale_instance_decisions(ent, dec), "seq") == [(5,)]
    clusters = entities.flag_clusters(ent)
    assert rows(clusters, "text", "classification", "instance_count", "distinct_docs") == [("Foo", "organisation", 2, 2), ("Foo", "unknown", 1, 1)]
    with pytest.raises(ValueError):
        redaction.resolve_all_flags(ent, "escalate")


def test_leak_check_spares_protected_phrases(spark):
    schema = "case_id string, ref string, entities array<struct<start:int,end:int,text:string,type:string,source:string,classification:string,redact:string>>"
    ents = [(0, 3, "Bob", "p", "m", "third_party", "redact"), (4, 8, "Acme", "o", "m", "third_party", "redact"), (9, 12, "Eve", "p", "m", "data_subject", "preserve")]
    tags = spark.createDataFrame([("c", "d", ents), ("c", "e", ents[:1])], schema)
    red = spark.createDataFrame([("c", "d", "[TP] acme bob Eve"), ("c", "e", "clean")], "case_id string, ref string, redacted string")
    prot = spark.createDataFrame([("c", ["acme ltd"])], "case_id string, protected array<string>")
    assert [(r.ref, r.leaks, r.status) for r in redaction.leak_check(red, tags, prot).orderBy("ref").collect()] == [("d", ["Bob"], "failed"), ("e", [], "redacted")]


# ---- people ----------------------------------------------------------------


def find(parent, x):
    while parent[x] != x:
        x = parent[x]
    return x


def groups(pairs):
    parent = {}
    for a, b in pairs:
        for x in (a, b):
            parent.setdefault(x, x)
        ra, rb = find(parent, a), find(parent, b)
        if ra != rb:
            parent[max(ra, rb)] = min(ra, rb)
    out = {}
    for x in parent:
        out.setdefault(find(parent, x), set()).add(x)
    return {frozenset(v) for v in out.values()}


def test_components_with_hot_key_and_long_chain(spark):
    rng = random.Random(9)
    links = [(f"n{i}", "hot") for i in range(200)] + [(f"m{i}", f"e{i}") for i in range(60)] + [(f"m{i + 1}", f"e{i}") for i in range(60)]
    links += [(f"r{rng.randint(0, 80)}", f"q{rng.randint(0, 60)}") for _ in range(90)]
    df = spark.createDataFrame([("c", *x) for x in links], "case_id string, node string, key string")
    got = {}
    for r in people.components(df).collect():
        got.setdefault(r.label, set()).add(r.node)
    want = {frozenset(x for x in g if not x.startswith("key ")) for g in groups((n, f"key {k}") for n, k in links)}
    assert {frozenset(v) for v in got.values()} == want


def grams(name):
    p = f"  {name} "
    return {p[i:i + 3] for i in range(len(p) - 2)}


def alike(a, b):
    x, y = grams(a), grams(b)
    return len(x & y) / (len(x) * len(y)) ** 0.5


@pytest.mark.parametrize("threshold", [0.5, 0.7, 0.85])
def test_similar_names_misses_nothing(spark, threshold):
    rng = random.Random(4)
    base = ["katherine", "jonathan", "elizabeth", "aa", "b"]
    names = {"".join(c if rng.random() > 0.15 else rng.choice("abcde") for c in rng.choice(base)) for _ in range(120)}
    df = spark.createDataFrame([("c", n) for n in names] * 2, "case_id string, name string")
    got = {(r.name_a, r.name_b) for r in people.similar_names(df, threshold).collect()}
    assert got == {(a, b) for a in names for b in names if a < b and alike(a, b) >= threshold - 1e-12}


def test_a_bucket_of_names_is_compared_in_many_tasks(spark, monkeypatch):
    """Names that share all their common trigrams: blocks of a bucket are dealt over tasks, whose number follows the comparisons; no
    pair is lost or comes twice."""
    rng = random.Random(9)
    monkeypatch.setattr(people, "BLOCK", 20, raising=False)
    monkeypatch.setattr(people, "TASK_PAIRS", 500, raising=False)
    names = sorted({"hohenbergstein" + "".join(rng.choice("abc") for _ in range(rng.randint(2, 6))) for _ in range(200)})
    df = spark.createDataFrame([("c", n) for n in names] + [("d", n) for n in names[:9]], "case_id string, name string")
    rows = people.similar_names(df, 0.8).withColumn("task", F.spark_partition_id()).collect()
    want = [(a, b) for a in names for b in names if a < b and alike(a, b) >= 0.8 - 1e-12]
    assert sorted((r.name_a, r.name_b) for r in rows if r.case_id == "c") == want
    assert sorted((r.name_a, r.name_b) for r in rows if r.case_id == "d") == [(a, b) for a, b in want if {a, b} <= set(names[:9])]
    assert len({r.task for r in rows}) > int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_alias_clusters_equal_brute_force(spark, sf):
    from caseweave.plans import people_queries as pq

    mentions = pq._person_mentions(spark, sf)
    data = mentions.collect()
    got = {}
    for r in people.alias_clusters(mentions, 0.7).collect():
        got.setdefault((r.case_id, r.cluster), set()).add((r.case_id, r.mention_id))
    pairs = []
    for r in data:
        me = (r.case_id, r.mention_id)
        pairs += [(me, me), (me, (r.case_id, "name", r.name.lower()))]
        if r.email:
            pairs.append((me, (r.case_id, "mail", r.email.lower())))
    names = sorted({(r.case_id, r.name.lower()) for r in data})
    pairs += [((c, "name", a), (c, "name", b)) for c, a in names for e, b in names if c == e and a < b and alike(a, b) >= 0.7]
    want = set()
    for g in groups_of_any(pairs):
        members = frozenset(x for x in g if len(x) == 2)
        if members:
            want.add(members)
    assert {frozenset(v) for v in got.values()} == want


def test_a_family_of_names_needs_few_links(spark):
    """5,000 names that are all alike: links grow with the names, not with their pairs."""
    names = [f"maria theresia von hohenberg {i:04d}" for i in range(5000)]
    df = spark.createDataFrame([("c", n) for n in names], "case_id string, name string").repartition(8)
    links, labels = people.name_forest(df, spark.createDataFrame([], "case_id string, node string, key string"), 0.7)
    assert links.select("key").distinct().count() < 2 * len(names)
    assert labels.count() == len(names) and labels.select("label").distinct().count() == 1


def test_strangers_that_share_trigrams_are_not_paired(spark, monkeypatch):
    """Names of a few syllables share trigrams, yet hardly any are similar: few pairs leave the join, where they are dealt out."""
    rng = random.Random(6)
    syllables = ["tion", "ing", "er", "the", "and", "on", "ble", "her", "st", "wh", "ati"]
    names = sorted({"".join(rng.choice(syllables) for _ in range(4)) for _ in range(900)})
    df = spark.createDataFrame([("c", n) for n in names], "case_id string, name string")
    seen, similar = [], people._similar

    def counted(pairs, *rest):
        seen.append(pairs.count())
        return similar(pairs, *rest)

    monkeypatch.setattr(people, "_similar", counted)
    _, labels = people.name_forest(df, spark.createDataFrame([], "case_id string, node string, key string"), 0.85)
    want = [(a, b) for a in names for b in names if a < b and alike(a, b) >= 0.85 - 1e-12]
    assert sum(seen) <= 3 * len(want)
    label = {r.node: r.label for r in labels.collect()}
    assert all(label[f"name:{a}"] == label[f"name:{b}"] for a, b in want)


@pytest.mark.parametrize("threshold", [0.6, 0.75, 0.9])
def test_name_forest_joins_what_all_pairs_join(spark, threshold):
    """Families, chains between them and strangers that share rare trigrams, in two cases, against all pairs."""
    rng = random.Random(int(100 * threshold))
    base = ["katherine", "katharina", "jonathan", "johannes", "elizabeth", "lisbeth", "aa", "b", ""]
    spoilt = lambda n: "".join(c if rng.random() > 0.2 else rng.choice("abce") for c in n)
    names = {(rng.choice("cd"), spoilt(rng.choice(base)) + rng.choice(["", "", " smith", " zyx", "zyx"])) for _ in range(260)}
    known = [("c", f"name:{n}", f"mail:{rng.randrange(40)}") for k, n in sorted(names) if k == "c" and n and rng.random() < 0.2]
    df = spark.createDataFrame(sorted(names) * 2, "case_id string, name string").repartition(5)
    _, labels = people.name_forest(df, spark.createDataFrame(known, "case_id string, node string, key string"), threshold)
    got = {}
    for r in labels.collect():
        got.setdefault((r.case_id, r.label), set()).add((r.case_id, r.node[5:]))
    pairs = [(a, b) for a in names for b in names if a[0] == b[0] and a[1] and b[1] and a < b and alike(a[1], b[1]) >= threshold - 1e-12]
    pairs += [((k, n[5:]), (k, "key", key)) for k, n, key in known]
    want = [frozenset(x for x in g if len(x) == 2) for g in groups_of_any(pairs)] if pairs else []
    assert {frozenset(v) for v in got.values() if len(v) > 1} == {w for w in want if len(w) > 1}


def groups_of_any(pairs):
    nodes = {repr(x): x for p in pairs for x in p}
    return [{nodes[k] for k in g} for g in groups((repr(a), repr(b)) for a, b in pairs)]


def test_denylist_hits_exact_and_fuzzy(spark):
    tok = spark.createDataFrame([("c", "d", "email", "A@x.org"), ("c", "d", "phone", "020 79"), ("c", "d", "name", "Jonathan Smith"), ("c", "e", "name", "Johnathan Smith"), ("c", "e", "name", "Zed"), ("o", "e", "name", "Jonathan Smith")], "case_id string, ref string, kind string, value string")
    deny = spark.createDataFrame([("c", "email", "a@X.org", True), ("c", "phone", "02079", True), ("c", "name", "jonathan smith", True), ("c", "name", "Zed", False)], "case_id string, kind string, value string, redact boolean")
    assert rows(people.denylist_hits(tok, deny, 0.8), "value", "match") == [("020 79", "exact"), ("A@x.org", "exact"), ("Johnathan Smith", "fuzzy"), ("Jonathan Smith", "exact")]


def test_ranking_survives_bad_values(spark):
    data = [("c", "Zed", "4", "5", "0.5", False), ("c", "Amy", "4", "5", "0.5", None), ("c", "Bad", "x", "5", "0", False), ("c", None, None, "5", "0", False), ("c", "Me", "99", "99", "0", True)]
    df = spark.createDataFrame(data, "case_id string, canonical_name string, mention_count string, distinct_doc_count string, is_subject_confidence string, is_data_subject boolean")
    got = [(r.canonical_name, r.ranking_score) for r in people.top_people(df).orderBy("rank").collect()]
    assert got == [("Amy", 10.0), ("Zed", 10.0), (None, 0.0), ("Bad", 0.0)]
    edge = df.withColumn("subject_centricity_score", F.when(F.col("canonical_name") == "Zed", 0.7).otherwise(0.71))
    assert rows(people.referent_candidates(edge), "canonical_name") == [("Amy",), ("Bad",), (None,)]


def test_merges_follow_chains(spark):
    dec = spark.createDataFrame([("c", f"k{i}", i, "merge_with", f"k{i + 1}", "") for i in range(9)], "case_id string, cluster_id string, seq int, action string, merge_target_id string, note string")
    targets = people.merge_targets(dec)
    assert {r.target for r in targets.collect()} == {"k9"}
    clusters = spark.createDataFrame([("c", f"k{i}", 2) for i in range(10)] + [("c", "solo", 1)], "case_id string, cluster_id string, mention_count int")
    members = spark.createDataFrame([("c", f"k{i}", "source_ref", f"doc{i % 4}") for i in range(10)], "case_id string, cluster_id string, kind string, value string")
    assert rows(people.merged_counts(clusters, members, targets), "cluster_id", "mention_count", "distinct_doc_count") == [("k9", 20, 4), ("solo", 1, 0)]


def _decided(spark, *data):
    return spark.createDataFrame([(*x, i) for i, x in enumerate(data)], "case_id string, cluster_id string, action string, merge_target_id string, note string, seq int")


def test_decisions_apply_in_order(spark):
    merge = lambda case, a, b: (case, a, "merge_with", b, None)
    dec = _decided(
        spark,
        merge("first", "A", "B"), merge("first", "A", "C"),  # only the first of a cluster
        merge("late", "B", "C"), merge("late", "A", "B"),  # the target is gone
        merge("swap", "A", "B"), merge("swap", "B", "A"),
        merge("ring", "A", "B"), merge("ring", "B", "C"), merge("ring", "C", "A"),
        merge("self", "A", "A"), merge("none", "A", None), merge("none", "A", ""), merge("unknown", "A", "X"),
        merge("freed", "B", "C"), merge("freed", "A", "B"), merge("freed", "D", "A"),  # a refused merge leaves its source
    )
    clusters = spark.createDataFrame([(r.case_id, c) for r in dec.select("case_id").distinct().collect() for c in "ABCD"], "case_id string, cluster_id string")
    got = rows(people.merge_targets(dec, clusters), "case_id", "cluster_id", "target")
    assert got == [("first", "A", "B"), ("freed", "B", "C"), ("freed", "D", "A"), ("late", "B", "C"), ("ring", "A", "C"), ("ring", "B", "C"), ("swap", "A", "B")]
    assert people.merge_targets(dec.limit(0), clusters).collect() == []


def test_denylist_and_aliases_follow_the_order(spark):
    dec = _decided(
        spark,
        ("c", "A", "accept_as_third_party", None, "x"), ("c", "A", "merge_with", "B", None), ("c", "A", "accept_as_third_party", None, "too late"),
        ("c", "B", "mark_subject_alias", None, None), ("c", "D", "merge_with", "B", None), ("c", "B", "accept_as_third_party", None, None),
        ("c", "D", "mark_subject_alias", None, None), ("c", "E", "preserve", None, "keep"), ("c", "E", "merge_with", "A", None),
    )
    clusters = spark.createDataFrame([("c", k, f"name {k}") for k in "ABCDE"], "case_id string, cluster_id string, canonical_name string")
    members = spark.createDataFrame([("c", k, kind, f"{kind} {k}") for k in "ABCDE" for kind in ("email", "phone", "title")], "case_id string, cluster_id string, kind string, value string")
    assert rows(people.decided_denylist(clusters, dec), "cluster_id", "redact", "operator_note") == [("B", True, ""), ("E", False, "keep")]
    subjects = spark.createDataFrame([("c", "name Z", "email A")], "case_id string, full_name string, email string")
    got = rows(people.subject_aliases(clusters, members, dec, subjects), "kind", "value")
    assert got == [("alias", "name B"), ("email", "email B"), ("phone", "phone A"), ("phone", "phone B")]


def test_quality_mode_tie_is_cautious(spark):
    df = spark.createDataFrame([("k", q) for q in ["high", "low", "low", "high", "unknown"]] + [("j", q) for q in ["high", "ocr_failure"]], "k string, text_quality string")
    assert rows(people.quality_mode(df, ["k"]), "k", "text_quality_summary") == [("j", "ocr_failure"), ("k", "low")]


def test_strategy_choice(spark):
    df = spark.createDataFrame(
        [("a", "x", 0.9, 10, False), ("a", "y", 0.9, 20, False), ("a", "w", 0.9, 20, False), ("a", "raw", 0.0, 50, True), ("b", "x", 0.0, 99, False), ("b", "raw", 0.0, 1, True)],
        "case_id string, name string, confidence double, priority int, is_universal_fallback boolean",
    )
    assert rows(people.choose_strategy(df), "case_id", "name") == [("a", "w"), ("b", "raw")]


def test_signatures_attach_to_the_nearest_person(spark):
    text = "Ann Lee\nCHIEF LEGAL OFFICER\nTel: +44 20 7946 0000\n" + "." * 400 + "\nSTATEMENT OF WORK and OTHER PARTY"
    docs = spark.createDataFrame([("c", "d", text)], "case_id string, ref string, text string")
    known = spark.createDataFrame([("c", "d", "ann", 0, 7)], "case_id string, ref string, cluster_id string, start int, end int")
    got = people.signature_candidates(docs, known).orderBy("start").collect()
    assert [(r.text.strip(), r.cluster_id, r.outcome, r.confidence) for r in got] == [
        ("CHIEF LEGAL OFFICER", "ann", "attached", None), ("Tel: +44 20 7946 0000", "ann", "attached", None), ("OTHER PARTY", None, "new_candidate", 0.5),
    ]


def test_header_people(spark):
    mail = "From: \"Lee, Ann\" <ann@x.org>\nCc: bob@y.org; Carl <carl@z.org>\nSubject: From: nobody\n\nTo: x"
    docs = spark.createDataFrame([("c", "d", mail)], "case_id string, ref string, text string")
    got = {(r.header, r.email) for r in people.header_people(docs).collect() if r.email}
    assert got == {("from", "ann@x.org"), ("cc", "bob@y.org"), ("cc", "carl@z.org")}


# ---- samples ---------------------------------------------------------------


def test_qa_sample_buckets(spark):
    data = [("big", f"d{i:04}", 0 if i % 2 else i % 17) for i in range(900)] + [("small", f"s{i}", i) for i in range(30)]
    df = spark.createDataFrame(data, "case_id string, ref string, entity_count int")
    first = sampling.qa_sample(df.repartition(9), 30, 7)
    got = rows(first, "case_id", "ref", "bucket")
    assert got == rows(sampling.qa_sample(df.repartition(3), 30, 7), "case_id", "ref", "bucket")
    by = {}
    for c, r, b in got:
        by.setdefault((c, b), []).append(r)
    assert {k: len(v) for k, v in by.items()} == {("big", "high"): 10, ("big", "medium"): 10, ("big", "random"): 10, ("small", "random"): 30}
    counts = {r: n for c, r, n in data}
    top = sorted((n for c, r, n in data if c == "big"), reverse=True)[:10]
    assert sorted((counts[r] for r in by[("big", "high")]), reverse=True) == top
    assert len({r for c, r, b in got if c == "big"}) == 30


def test_calibration_sample_undersamples(spark):
    df = spark.createDataFrame([("c", f"a{i}", "disputed_recheck_says_bio") for i in range(50)] + [("c", f"b{i}", "recheck_ambiguous") for i in range(3)] + [("c", "n", None)], "case_id string, ref string, stratum string")
    got = sampling.calibration_sample(df, 1).groupBy("stratum").count()
    assert rows(got, "stratum", "count") == [("disputed_recheck_says_bio", 10), ("recheck_ambiguous", 3)]


def test_jury_sample_rates_floor_and_queue(spark):
    data = [("c", f"h{i}", 50, "high") for i in range(95)] + [("c", f"o{i}", 0, "ocr_failure") for i in range(4)] + [("c", f"v{i}", 0, None) for i in range(10)]
    df = spark.createDataFrame(data, "case_id string, ref string, entity_count int, text_quality string")
    got = {tuple(r)[:2]: r["count"] for r in sampling.jury_sample(df, seed=2).groupBy("band", "queue").count().collect()}
    assert got == {("high_ner", "jury"): 10, ("very_low_ner", "jury"): 8, ("very_low_ner", "manual"): 4}
    top = sampling.jury_sample(df, min_floor=40, seed=2)
    assert top.filter("queue <> 'manual'").count() == 40 and top.select("ref").distinct().count() == 44
    assert sampling.jury_sample(df, mode="full").count() == 109
    assert sampling.jury_sample(df, min_floor=10_000).count() == 109


def test_walkthrough_progress(spark):
    docs = spark.createDataFrame([("c", f"d{i}", "redacted" if i < 30 else "failed") for i in range(40)], "case_id string, ref string, status string")
    sample = sampling.walkthrough_sample(docs, 10, 3)
    assert sample.first().eligible_pool_size == 30
    refs = [r.ref for r in sample.orderBy("position").collect()]
    dec = spark.createDataFrame([("c", refs[0], 1, "approve"), ("c", refs[1], 2, "approve"), ("c", refs[1], 3, "escalate")], "case_id string, ref string, seq int, decision string")
    row = sampling.sample_progress(sample, dec).first()
    assert (row.total, row.approved, row.declined, row.pending, row.next_pending, row.complete) == (10, 1, 1, 8, 2, False)


# ---- review ----------------------------------------------------------------


def test_queue_scores(spark):
    items = spark.createDataFrame(
        [("c", "blocker", "b1", 10, "release_gate_running", 0), ("c", "leak_review", "l1", 6, "redaction_running", 1), ("c", "unextractable", "u1", 4, "ingestion_qc_running", 2), ("d", "leak_review", "l2", 6, "redaction_running", 1)],
        "case_id string, kind string, item_id string, risk int, stage string, source_ord int",
    )
    cases = spark.createDataFrame([("c", "redaction_running", "2024-06-10"), ("d", "odd", None)], "case_id string, current_stage string, received string").withColumn("received", F.col("received").try_cast("date"))
    recent = spark.createDataFrame([("c", ["leak_review", "leak_review"])], "case_id string, recent array<string>")
    got = {r.item_id: round(r.score, 6) for r in review.scored_queue(items, cases, recent, asof()).collect()}
    sla = 20 / 30
    assert got == {
        "l1": round(0.4 * 0.6 + 0.3 * sla + 0.15 * 0 - 0.1 * 2 / 3, 6),
        "u1": round(0.4 * 0.4 + 0.3 * sla + 0.15 * 1.0 + 0.05, 6),
    }


def test_phase_status(spark):
    got = {r.phase: r.status for r in review.phase_status(spark.createDataFrame([("c", "responsiveness_running")], "case_id string, current_stage string")).collect()}
    assert got == {"discovery": "done", "filter": "current", "redact": "pending", "release": "pending"}
    lost = review.phase_status(spark.createDataFrame([("c", "??")], "case_id string, current_stage string"))
    assert {r.status for r in lost.collect()} == {"pending"}


def test_waivers(spark):
    log = [("w1", 1, "pending"), ("w1", 5, "co_signed"), ("w2", 2, "pending"), ("w3", 3, "co_signed"), ("w1", 6, "co_signed"), ("w2", 9, "pending")]
    df = spark.createDataFrame([("c", w, s, st, "op", "j", "dpo") for w, s, st in log], "case_id string, waiver_id string, seq int, state string, operator_id string, justification string, dpo_id string")
    assert rows(review.waiver_states(df), "waiver_id", "state", "rejected_transitions") == [("w1", "co_signed", 1), ("w2", "pending", 1), ("w3", "invalid", 1)]


# ---- quality ---------------------------------------------------------------


def test_extraction_gate_edges_are_strict(spark):
    def case(name, bad, total):
        return [(name, "ocr_failure" if i < bad else None) for i in range(total)]

    df = spark.createDataFrame(case("half", 5, 10) + case("over", 6, 10) + case("tenth", 1, 10) + case("more", 2, 10), "case_id string, text_quality string")
    cases = spark.createDataFrame([(c,) for c in ("half", "over", "tenth", "more", "void")], "case_id string")
    assert rows(quality.extraction_gate(df, cases), "case_id", "gate") == [("half", "warning"), ("more", "warning"), ("over", "catastrophic"), ("tenth", "ok"), ("void", "empty_ingest")]


def test_reason_codes_and_pending(spark):
    df = spark.createDataFrame(
        [("R001", None, "2024-06-30T11:00:00Z"), ("R006", " ", "x"), ("R006", "n", ""), ("R777", "n", ""), ("", "n", ""), ("R-PENDING", "n", "2024-06-29T12:00:00+00:00"), ("R-PENDING", "n", "2024-06-29T11:59:59Z"), ("R-PENDING", "n", "soon")],
        "reason_code string, note string, ts string",
    )
    assert [r.error for r in quality.reason_code_audit(df).collect()] == [None, "note_required", None, "unknown_code", "missing_code", None, None, None]
    assert [r.is_stale for r in quality.stale_pending(df, asof()).collect()] == [False, True, True]


def test_times(spark):
    stamps = ["2024-06-30T10:00:00Z", "2024-06-30T10:00:00.123456+02:00", "2024-06-30T10:00:00", "2024-07-01", "bad", None]
    df = spark.createDataFrame([(s,) for s in stamps], "s string").select(times.age_hours(times.parse_iso(F.col("s")), asof()).alias("h"))
    assert [round(r.h, 3) for r in df.collect()] == [2.0, 4.0, 2.0, 0.0, 0.0, 0.0]


def test_release_intake_quarantines(spark):
    import json

    good = dict.fromkeys(vocab.RELEASE_KEYS, "x") | {"decision": "REJECT", "risk_level": "LOW", "blocking_issues": [dict.fromkeys(vocab.BLOCKER_KEYS, "y") | {"severity": "HIGH"}]}
    bad_issue = good | {"blocking_issues": [{"issue_id": "1", "severity": "HIGH"}]}
    docs = [json.dumps(good), json.dumps(good | {"decision": "MAYBE"}), json.dumps(good | {"extra": 1}), "nope", "[1]", json.dumps(bad_issue)]
    got = [r.errors for r in quality.release_intake(spark.createDataFrame([(d,) for d in docs], "body string").coalesce(1)).collect()]
    assert got[0] == [] and got[1] == ["decision"] and got[2] == ["unexpected:extra"] and got[3] == ["not_json"] and got[4] == ["not_json"] and got[5] == ["blocking_issues"]


def test_prompt_provenance_ladder(spark):
    reg = spark.createDataFrame([("s1", "p", "1", False), ("s2", "p", "2", True)], "seal string, prompt_id string, version string, is_current boolean")
    eff = spark.createDataFrame([("s1", "-", "e1"), ("s2", "-", "e2")], "seal string, strips string, effective_sha256 string")
    data = [("p", "s2", "-", "e2", False), ("p", "s1", "-", "e1", False), ("p", "s2", "-", "zz", False), ("q", "s2", "-", "e2", False), ("p", "s9", "-", "e2", False), ("p", None, "-", "e2", False), ("p", "s2", "-", "e2", True)]
    df = spark.createDataFrame(data, "prompt_id string, seal string, strips string, effective_sha256 string, malformed boolean")
    got = sorted(r.status for r in quality.prompt_provenance(df, reg, eff).collect())
    assert got == sorted(["ok", "older_version", "effective_drift", "prompt_id_mismatch", "unknown_seal", "missing_seal", "malformed"])


def test_fitness_lookup_reasons(spark):
    req = spark.createDataFrame([(i, d, "m", "p", None, "corp", "par") for i, d in (("ok", "a"), ("none", "z"), ("old", "b"), ("drift", "c"), ("fail", "d"), ("params", "e"))], "request_id string, deployment_id string, model_alias string, primary_seal string, recheck_seal string, corpus_sha string, params_sha string")
    rep = spark.createDataFrame(
        [("a", "m", "p", None, None, "corp", "r1", True, [], "2024-06-20T00:00:00Z"), ("a", "m", "p", None, None, "corp", "r0", False, ["x"], "2024-06-10T00:00:00Z"), ("a", "m", "p", None, None, "corp", "r9", False, ["x"], "garbage"),
         ("b", "m", "p", None, "par", "corp", "r2", True, [], "2023-01-01T00:00:00Z"), ("c", "m", "p", None, "par", "other", "r3", True, [], "2024-06-20T00:00:00Z"),
         ("d", "m", "p", None, "par", "corp", "r4", False, ["model:x"], "2024-06-20T00:00:00Z"), ("e", "m", "p", None, "else", "corp", "r5", True, [], "2024-06-20T00:00:00Z")],
        "deployment_id string, model_alias string, primary_seal string, recheck_seal string, params_sha string, corpus_sha string, report_id string, passed boolean, fails array<string>, generated_at string",
    )
    got = {r.request_id: (r.report_id, r.reason) for r in quality.fitness_lookup(req, rep, asof()).collect()}
    assert got == {"ok": ("r1", None), "none": (None, "no_matching_report"), "old": (None, "stale"), "drift": (None, "corpus_drift"), "fail": (None, "fitness_failed:model:x"), "params": (None, "no_matching_report")}


# ---- integrity -------------------------------------------------------------


def flat_hash(pairs):
    h = hashlib.sha256()
    for label, sub in sorted(pairs):
        h.update(f"{label}\x1f{sub}\x1e".encode())
    return h.hexdigest()


def tree_hash(pairs):
    leaves, nodes = {}, {}
    for label, sub in pairs:
        leaves.setdefault(hashlib.sha256(label.encode()).hexdigest()[:6], []).append((label, sub))
    for path, own in leaves.items():
        nodes.setdefault(path[:3], []).append((path, flat_hash(own)))
    return flat_hash([(path, flat_hash(own)) for path, own in nodes.items()])


def test_set_hash_has_one_form_at_every_size(spark):
    pairs = [(f"f{i}é", hashlib.sha256(str(i).encode()).hexdigest()) for i in range(9000)]
    df = spark.createDataFrame([("c", *p) for p in pairs], "case_id string, ref string, hash string")
    for n in (1, 2, 300, 9000):
        part = df.limit(n).repartition(6)
        own = [(r.ref, r.hash) for r in part.collect()]
        assert integrity.set_hash(part, ["case_id"], "ref", "hash").first() == ("c", n, tree_hash(own))
        assert integrity.listing_hash(part, ["case_id"], "ref", "hash").first() == ("c", n, flat_hash(own))


def test_chain_emission_and_tampering(spark):
    ev = spark.createDataFrame([("c", i, f"b{i}") for i in range(1, 25)], "case_id string, seq int, body string")
    chain = integrity.emit_chain(ev, width=5)
    record = {i: hashlib.sha256(f'{{"body":"b{i}","seq":{i}}}'.encode()).hexdigest() for i in range(1, 25)}
    assert {r.seq: (r.prev_hash, r.event_hash) for r in chain.collect()} == {i: (record.get(i - 1), record[i]) for i in range(1, 25)}
    assert integrity.chain_heads(chain).first() == ("c", 24, tree_hash([(str(i), h) for i, h in record.items()]))
    bad = lambda df: [(r.seq, r.status) for r in integrity.verify_chain(df, width=7).orderBy("seq").collect() if r.status not in ("ok", "genesis")]
    assert bad(chain) == []
    assert bad(chain.filter("seq <> 13")) == [(14, "broken")]
    assert bad(chain.filter("seq <> 1")) == [(2, "missing_predecessor")]
    changed = chain.withColumn("body", F.when(F.col("seq") == 9, "x").otherwise(F.col("body")))
    assert bad(changed) == [(9, "altered")]
    cut = integrity.chain_summary(integrity.verify_chain(chain.filter("seq <> 13"), width=7)).first()
    assert (cut.intact, cut.breaks, cut.first_break) == (False, 1, 14)
    assert rows(integrity.seq_gaps(chain.filter("seq not in (13, 14)"), width=5), "expected_seq", "found_seq", "missing") == [(13, 15, 2)]


def test_resume_forces_everything_after(spark):
    cases = spark.createDataFrame([("a",), ("b",)], "case_id string")
    subs = [s for _, group in vocab.STAGE_ORDER for s in group]
    fresh = spark.createDataFrame([("a", s, True) for s in subs] + [("b", s, s != "embed") for s in subs], "case_id string, stage string, is_fresh boolean")
    got = {(r.case_id, r.coarse): r.will_run for r in integrity.resume_plan(fresh, cases).collect()}
    assert not any(v for (c, _), v in got.items() if c == "a")
    assert not got[("b", "ingest")] and got[("b", "stage_2_parallel")] and got[("b", "export")]


def test_compensated_failures_are_not_orphans(spark):
    chain = spark.createDataFrame([("c", "h1", "reviewer_decision_made", None), ("c", "h2", "reviewer_decision_made", None), ("c", "h3", "reviewer_decision_made", None), ("c", "h4", "failure_recorded", "h2")], "case_id string, event_hash string, event_type string, original_event_hash string")
    log = spark.createDataFrame([("c", "h1"), ("c", "h9")], "case_id string, event_hash string")
    assert rows(integrity.uncompensated(chain, log), "event_hash", "side") == [("h3", "chain_only"), ("h9", "log_only")]


def test_upstream_reasons(spark):
    cur = spark.createDataFrame([("c", s, h) for s, h in (("a", "h"), ("b", "h"), ("d", ""), ("e", "h"), ("f", "h"), ("g", "h"))], "case_id string, stage string, upstream_hash string")
    man = spark.createDataFrame([("c", "a", True, 1, "h"), ("c", "b", True, 1, "x"), ("c", "d", True, 1, "h"), ("c", "e", True, 0, "h"), ("c", "f", True, 1, None)], "case_id string, stage string, present boolean, n_rows int, recorded_hash string")
    assert [r.reason for r in integrity.upstream_check(man, cur).orderBy("stage").collect()] == [
        "artefact present + hash matches", "hash mismatch", "upstream empty", "artefact empty", "no upstream_hash field", "artefact missing",
    ]


def test_corpus_seal_needs_every_label(spark):
    files = spark.createDataFrame([("c", "a", "x\r\ny"), ("c", "a", "x\ny"), ("c", "b", "z"), ("d", "a", "q")], "case_id string, ref string, text string")
    truth = spark.createDataFrame([("c", "a", "gold"), ("c", "b", "mid")], "case_id string, ref string, label string")
    got = {r.case_id: (r.n_members, r.unlabelled, r.seal is None) for r in integrity.corpus_seal(files, truth).collect()}
    assert got == {"c": (2, 0, False), "d": (1, 1, True)}


# ---- figures ---------------------------------------------------------------


def test_live_funnel_never_negative(spark):
    ing = spark.createDataFrame([("c", "a")], "case_id string, ref string")
    prim = spark.createDataFrame([("c", "biographical")], "case_id string, primary_verdict string")
    red = spark.createDataFrame([("c", "redacted")], "case_id string, status string")
    leak = spark.createDataFrame([("c", "a", 1, "accept_exclude"), ("c", "b", 1, "accept_exclude"), ("c", "a", 2, "pending")], "case_id string, ref string, seq int, decision string")
    row = metrics.live_funnel(ing, prim, red, leak, leak).first()
    assert (row.final_rows, row.final, row.leak_excluded_rows, row.leak_excluded, row.qa_decided) == (0, 0, 2, 1, 1)


def test_unresolved_blockers(spark):
    schema = "case_id string, seq int, ts string, blocking_issues array<struct<issue_id:string,issue:string,severity:string>>"
    v = spark.createDataFrame([("c", 1, "t", [("old", "o", "HIGH")]), ("c", 2, "t", [("a", "x", "CRITICAL"), ("b", "y", "HIGH"), ("", "z", "LOW")])], schema)
    done = spark.createDataFrame([("c", "b")], "case_id string, issue_id string")
    row = review.blocker_summary(v, done).first()
    assert (row.total, row.open, row.open_critical, row.open_high) == (3, 1, 1, 0)


def test_listing_streams_through_its_digest(spark):
    """No task holds a listing: rows come sorted, in batches smaller than a group, and give the same digest."""
    rows = [(f"c{i % 3}" if i % 3 else None, f"é{i:05d}" if i % 50 else None, f"h{i}") for i in range(4000)]
    df = spark.createDataFrame(rows, "case_id string, ref string, hash string").repartition(5)
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        out = integrity.listing_hash(df, ["case_id"], "ref", "hash")
        got = {r["case_id"]: (r["n_members"], r["set_hash"]) for r in out.collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    assert "collect_list" not in out._jdf.queryExecution().toString()
    want = {}
    for case in {r[0] for r in rows}:
        own = sorted((r[1], r[2]) for r in rows if r[0] == case and r[1] is not None)
        text = "".join(f"{a}\x1f{b}\x1e" for a, b in own)
        want[case] = (sum(r[0] == case for r in rows), hashlib.sha256(text.encode()).hexdigest())
    assert got == want
    assert integrity.listing_hash(df.limit(0), ["case_id"], "ref", "hash").count() == 0


def test_rerank_rows_are_checked_for_fields_and_mode(spark):
    rows = [("a", "r1", 0.5, False, "shadow", "h"), ("a", "r2", 0.5, False, "enforce", None), ("b", "r1", 0.5, True, "enforce", "h")]
    df = spark.createDataFrame(rows, "case_id string, ref string, rerank_score double, would_drop boolean, mode string, upstream_hash string")
    got = {(r.case_id, r.check): (r.n_bad, r.severity) for r in quality.check_rerank(df, "shadow").collect()}
    assert got == {
        ("a", "rerank_fields"): (1, "critical"), ("a", "rerank_mode"): (1, "info"),
        ("b", "rerank_fields"): (0, "info"), ("b", "rerank_mode"): (1, "warning"),
    }
    assert quality.check_rerank(df, "off").count() == 0
