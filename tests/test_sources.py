"""Readers and sinks over small case folders."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from caseweave import schemas
from caseweave.sources import artefacts, corpus, jsonl, sinks


@pytest.fixture()
def case(tmp_path):
    for name in ("working", "audit", "source/sub"):
        (tmp_path / "case-7" / name).mkdir(parents=True)
    return tmp_path / "case-7"


def write(path, *lines):
    path.write_bytes(b"\n".join(x if isinstance(x, bytes) else x.encode() for x in lines) + b"\n")


def test_lenient_reader_skips_what_does_not_parse(spark, case):
    write(case / "audit" / "qa.jsonl", '{"doc_ref": "a", "decision": "approve"}', "", "{oops", '{"doc_ref": "b"}', "   ")
    df = jsonl.read_lenient(spark, str(case / "audit" / "qa.jsonl"), schemas.DECISIONS)
    assert sorted((r.case_id, r.doc_ref, r.decision) for r in df.collect()) == [("case-7", "a", "approve"), ("case-7", "b", None)]
    assert df.count() == 2
    assert jsonl.read_lenient(spark, str(case / "audit" / "none*.jsonl"), schemas.DECISIONS).count() == 0


def test_strict_reader_stops(spark, case):
    good, bad = case / "working" / "good.jsonl", case / "working" / "bad.jsonl"
    write(good, '{"ref": "a", "embedding": [1.0], "upstream_hash": "h"}')
    write(bad, '{"ref": "a"}')
    assert jsonl.read_strict(spark, str(good), schemas.EMBEDDINGS, ["ref", "embedding"]).count() == 1
    with pytest.raises(Exception, match="malformed or incomplete"):
        jsonl.read_strict(spark, str(bad), schemas.EMBEDDINGS, ["ref", "embedding"]).collect()


def test_audited_reader_keeps_errors_and_sizes(spark, case):
    write(case / "audit" / "log.jsonl", *(['{"ref": "a", "verdict": "x"}'] * 6), "broken " + "y" * 300)
    rows, sizes = jsonl.read_audited(spark, str(case / "audit" / "log.jsonl"), "ref string, verdict string", cap=5)
    errors = [r.parse_error for r in rows.collect() if r.parse_error]
    assert len(errors) == 1 and len(errors[0]) == 120
    row = sizes.first()
    assert (row.n_rows, row.n_malformed, row.over_cap) == (7, 1, True)


def test_line_numbers_follow_the_file_across_splits(spark, case):
    path = case / "audit" / "big.jsonl"
    write(path, *[json.dumps({"ref": f"r{i}", "verdict": "v" * (i % 50)}) for i in range(4000)], "{bad")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1k")
    try:
        assert spark.read.text(str(path)).rdd.getNumPartitions() > 3
        rows = jsonl.read_numbered(spark, str(path), "ref string, verdict string").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert len(rows) == 4001
    assert all(r.ref == f"r{r.seq - 1}" for r in rows if r.decode_error is None)
    assert [r.seq for r in rows if r.decode_error] == [4001]


def test_defensive_reader_gives_reasons(spark, case):
    path = case / "audit" / "odd.jsonl"
    write(path, '{"ref": "a"}', b'{"ref": "\xff\xfe"}', '{"ref": "' + "z" * 500 + '"}', "[1, 2]", "{nope", "", "12")
    good, bad = jsonl.read_defensive(spark, str(path), "ref string", cap=300)
    assert [(r.seq, r.ref) for r in good.collect()] == [(1, "a")]
    assert {r.seq: r.reject_reason for r in bad.collect()} == {2: "not_utf8", 3: "oversize", 4: "not_object", 5: "malformed", 7: "not_object"}


def test_register_must_be_an_array(spark, case):
    ok, bad = case / "working" / "register.json", case / "working" / "other.json"
    ok.write_text(json.dumps([{"ref": "a", "path": "p/a.eml"}, {"ref": "b"}], indent=1))
    bad.write_text(json.dumps({"refs": []}))
    assert sorted((r.case_id, r.ref, r.path) for r in artefacts.read_register(spark, str(ok)).collect()) == [("case-7", "a", "p/a.eml"), ("case-7", "b", None)]
    with pytest.raises(Exception, match="not a JSON array"):
        artefacts.read_register(spark, str(bad)).collect()


def test_tags_keep_the_three_redact_states(spark, case):
    ents = [{"text": "A", "redact": True, "start": 0, "end": 1}, {"text": "B", "redact": False, "start": "2", "end": 3}, {"text": "C", "redact": "flag", "start": "x"}]
    (case / "working" / "d1_tags.json").write_text(json.dumps({"filename": "f", "entities": ents}))
    (case / "working" / "d2_tags.json").write_text("{broken")
    tags = artefacts.read_tags(spark, str(case / "working" / "*_tags.json"))
    row = tags.collect()
    assert len(row) == 1 and row[0].ref == "d1" and row[0].case_id == "case-7"
    assert [(e.redact, e.start, e.end) for e in row[0].entities] == [("redact", 0, 1), ("preserve", 2, 3), ("flag", None, None)]
    with pytest.raises(Exception):
        artefacts.read_tags(spark, str(case / "working" / "*_tags.json"), strict=True).collect()


def test_texts_and_hashes(spark, case):
    (case / "working" / "d1.txt").write_bytes(b"caf\xc3\xa9 \xff end")
    row = artefacts.read_texts(spark, str(case / "working" / "*.txt")).first()
    assert (row.case_id, row.ref) == ("case-7", "d1") and row.text == "café � end"
    (case / "source" / "a.eml").write_bytes(b"one")
    (case / "source" / "sub" / "b c.pdf").write_bytes(b"two")
    got = {r.path: r.digest for r in artefacts.read_file_hashes(spark, str(case / "source")).collect()}
    assert got["a.eml"] == hashlib.sha256(b"one").hexdigest() and len(got) == 2


def test_log_collection(spark, case):
    write(case / "audit" / "pipeline.jsonl", '{"event": "stage_end", "stage": "bake", "duration_s": 1.5}', "junk")
    write(case / "working" / "scope_recheck.jsonl", '{"ref": "a", "verdict": "disputed"}')
    logs = artefacts.collect_logs(spark, str(case.parent))
    assert sorted((r.source, r.case_id, r.stage, r.verdict) for r in logs.collect()) == [
        ("pipeline.jsonl", "case-7", "bake", None), ("scope_recheck.jsonl", "case-7", None, "disputed"),
    ]
    assert artefacts.collect_logs(spark, str(case.parent / "nowhere")).count() == 0


def test_artefact_replacement_leaves_other_cases(spark, tmp_path):
    path = str(tmp_path / "art")
    both = spark.createDataFrame([("a", 1), ("b", 1)], "case_id string, v int")
    sinks.replace_artefact(sinks.stamped(both, "h1"), path)
    sinks.replace_artefact(sinks.stamped(both.filter("case_id = 'a'").withColumn("v", F.lit(2)), "h2"), path)
    assert sorted((r.case_id, r.v, r.upstream_hash, r.schema_version != "") for r in spark.read.parquet(path).collect()) == [("a", 2, "h2", True), ("b", 1, "h1", True)]


def test_snapshot_sections_are_independent(spark, tmp_path):
    path = str(tmp_path / "snap")
    now = F.lit("t")
    sinks.append_log(sinks.snapshot_rows(spark.createDataFrame([("c", 1)], "case_id string, n int"), "funnel", F.lit(1), now), path)
    sinks.append_log(sinks.snapshot_rows(spark.createDataFrame([("c", 9)], "case_id string, w int"), "scale", F.lit(2), now), path)
    sinks.append_log(sinks.snapshot_rows(spark.createDataFrame([("c", 5)], "case_id string, n int"), "funnel", F.lit(3), now), path)
    assert {r.section: r.payload for r in sinks.read_snapshot(spark.read.parquet(path)).collect()} == {"funnel": '{"n":5}', "scale": '{"w":9}'}
    with pytest.raises(ValueError):
        sinks.append_log(spark.createDataFrame([("c",)], "case_id string"), path)


@pytest.mark.parametrize("count", [100, 7, 250])
def test_synthetic_case_mix(spark, count):
    rows = corpus.synthesize_case(spark, "800001", count, 5).collect()
    assert len(rows) == count and len({r.ref for r in rows}) == count
    mix = {}
    for r in rows:
        mix[r.truth_class] = mix.get(r.truth_class, 0) + 1
    if count == 100:
        assert mix == {"gold": 30, "mid": 12, "decoy": 10, "off_finance": 13, "off_topic": 35}
    again = corpus.synthesize_case(spark, "800001", count, 5).collect()
    assert sorted(rows) == sorted(again)
    if count == 100:
        assert sorted(rows) != sorted(corpus.synthesize_case(spark, "800001", count, 6).collect())
