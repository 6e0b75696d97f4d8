"""The feed: projection, replay, running state, gaps and silence."""

import json
import os
import random
import time

import numpy as np
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from caseweave.functions import vocab
from caseweave.session import run_folder
from caseweave.streaming import feed, progress, projection, state_table, watch

TS = "2024-05-01T10:00:00Z"


def project(spark, *events):
    rows = [(i, "L1", ts, kind, body if isinstance(body, str) or body is None else json.dumps(body)) for i, (ts, kind, body) in enumerate(events)]
    df = spark.createDataFrame(rows, "i int, source string, ts string, event_type string, payload string")
    return projection.project(df, keep=["i"]).orderBy("i").collect()


def test_unknown_types_and_odd_payloads_give_nothing_away(spark):
    canary = "jane.roe@example.com"
    bodies = [{"message": canary, "kind": "info", "stage": canary}, [canary], canary, None, "{broken", {"severity": canary}]
    for kind in [None, "", "MADE_UP", *vocab.EVENT_FIELDS]:
        for r in project(spark, *[(canary, kind, b) for b in bodies]):
            assert canary not in " ".join(str(v) for v in r)
            assert r.ts == vocab.TYPE_ERROR
    unknown = project(spark, (TS, "MADE_UP", {"stage": "redact"}))[0]
    assert (unknown.event_type, unknown.stage, unknown.severity, unknown.summary) == (None, None, None, vocab.SUMMARY_UNKNOWN)


def test_scrubbing_edges(spark):
    got = project(
        spark,
        (TS, "REDACT_COMPLETED", {"stage": "redact", "refs_processed": 10_000_000, "redactions_applied": 10_000_001}),
        (TS, "REDACT_COMPLETED", {"stage": "nope", "refs_processed": True, "redactions_applied": 0}),
        (TS, "REDACT_COMPLETED", {"refs_processed": 5.0, "redactions_applied": "7"}),
        ("2024-05-01T10:00:00.123456+01:00", "stage_end", {"stage": "bake", "duration_s": 86400, "ts": TS}),
        ("2024-05-01 10:00:00", "stage_end", {"stage": "bake", "duration_s": 0.5}),
        (TS, "stage_end", {"stage": "bake", "duration_s": False}),
        (TS, "note", {"kind": "warn", "severity": "error"}),
        (TS, "note", {"kind": None, "severity": None}),
    )
    err = vocab.TYPE_ERROR
    assert [r.summary for r in got] == [
        f"redacted {err} of 10000000 refs", f"redacted 0 of {err} refs", f"redacted {err} of {err} refs", "stage ended: bake (86400s)",
        "stage ended: bake (0.5s)", f"stage ended: bake ({err}s)", "note (warn)", f"note ({err})",
    ]
    assert [r.stage for r in got[:3]] == ["redact", err, None]
    assert got[3].ts.endswith("+01:00") and got[4].ts == err
    assert [got[0].severity, got[6].severity, got[7].severity] == ["info", "error", err]


def test_dialects_and_long_lines(spark):
    lines = [json.dumps(x) for x in ({"event_type": "", "event": "note", "ts": "", "timestamp": TS, "kind": "info"}, {"template_id": "stage_start", "ts": TS, "payload": {"stage": "ingest"}})]
    lines.append(json.dumps({"event": "note", "pad": "p" * 400}))
    df = spark.createDataFrame([(x, "L3") for x in lines], "value string, source string")
    guarded = feed.parse_events(feed.guarded(df, cap=300))
    got = [(r.event_type, r.ts) for r in guarded.collect()]
    assert got == [("note", TS), ("stage_start", TS), ("line_too_long", None)]
    assert [r.summary for r in projection.project(guarded).collect()] == ["note (info)", "stage started: ingest", vocab.SUMMARY_UNKNOWN]


def test_replay_includes_its_edge(spark):
    df = spark.createDataFrame([("2024-05-01 10:00:00.9",), ("2024-05-01 09:59:30.1",), ("2024-05-01 09:59:29.9",)], "t string").withColumn("event_ts", F.to_timestamp("t"))
    assert feed.replay(df, F.to_timestamp(F.lit("2024-05-01 10:00:00.5")), 30).count() == 2


def test_feed_from_files_equals_batch(spark, tmp_path):
    folder = tmp_path / "case-1" / "audit"
    folder.mkdir(parents=True)
    for part in range(3):
        lines = [json.dumps({"event": "stage_end", "ts": TS, "stage": "redact", "duration_s": i}) for i in range(part, part + 4)]
        (folder / f"seg{part}.jsonl").write_text("\n".join(lines) + "\n")
    stream = feed.live_projection(spark, {"L3": str(folder)})
    out = run_folder(spark, "feed")
    q = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", run_folder(spark, "ck")).trigger(availableNow=True).start()
    q.awaitTermination()
    got = spark.read.parquet(out).collect()
    assert len(got) == 12 and {r.case_id for r in got} == {"case-1"} and {r.source for r in got} == {"L3"}
    assert sorted(r.summary for r in got)[0] == "stage ended: redact (0s)"


def decision_stream(spark, folder):
    return spark.readStream.schema("case_id string, ref string, seq bigint, decision string").option("maxFilesPerTrigger", 1).json(str(folder))


def land(folder, n, rows):
    folder.mkdir(exist_ok=True)
    (folder / f"part{n}.json").write_text("\n".join(json.dumps(dict(zip(("case_id", "ref", "seq", "decision"), r))) for r in rows) + "\n")


def test_state_survives_a_restart(spark, tmp_path):
    src = tmp_path / "in"
    out, check = run_folder(spark, "state"), run_folder(spark, "ck")
    land(src, 0, [("c", "a", 1, "pending"), ("c", "b", 2, "accept_exclude")])
    feed.append_updates(feed.funnel_updates(decision_stream(spark, src)), out, check).awaitTermination()
    land(src, 1, [("c", "a", 3, "accept_exclude"), ("d", "x", 1, "")])
    feed.append_updates(feed.funnel_updates(decision_stream(spark, src)), out, check).awaitTermination()
    got = {r.case_id: (r.decisions, r.leak_excluded, r.decided) for r in feed.current_state(spark, out, ["case_id"]).collect()}
    assert got == {"c": (3, 2, 2), "d": (1, 0, 0)}


def test_latest_decision_ignores_arrival_order(spark, tmp_path):
    src = tmp_path / "in"
    out, check = run_folder(spark, "latest"), run_folder(spark, "ck")
    land(src, 0, [("c", "a", 9, "new"), ("c", "a", 4, "mid")])
    land(src, 1, [("c", "a", 2, "old"), ("c", "b", 1, "only")])
    feed.latest_decisions_stream(decision_stream(spark, src), out, check).awaitTermination()
    assert {r.ref: r.decision for r in feed.current_state(spark, out, ["case_id", "ref"], "seq").collect()} == {"a": "new", "b": "only"}


def test_gaps_across_batches(spark, tmp_path):
    watch.use_rocksdb(spark)
    src = tmp_path / "in"
    land(src, 0, [("c", "", s, "") for s in (1, 2, 5)])
    time.sleep(1.1)
    land(src, 1, [("c", "", s, "") for s in (9, 6, 7)] + [("d", "", 4, "")])
    rows = decision_stream(spark, src).select("case_id", F.lit("L1").alias("source"), "seq")
    out = run_folder(spark, "gaps")
    q = watch.gap_stream(rows).writeStream.format("parquet").option("path", out).option("checkpointLocation", run_folder(spark, "ck")).trigger(availableNow=True).start()
    q.awaitTermination()
    changes = spark.read.schema(watch.GAPS).parquet(out)
    got = sorted((r.case_id, r.expected_seq, r.found_seq, r.missing) for r in changes.filter("sign <> 0").collect())
    assert got == [("c", 3, 5, 2), ("c", 8, 9, 1)]
    assert got == sorted((r.case_id, r.expected_seq, r.found_seq, r.missing) for r in watch.open_gaps(changes).collect())


def test_gaps_do_not_depend_on_batches(spark, tmp_path):
    watch.use_rocksdb(spark)
    src = tmp_path / "in"
    for n, seqs in enumerate([(8, 20, 14), (10, 9, 30), (3, 15, 13, 21), (25, 4, 8)]):
        land(src, n, [("c", "", s, "") for s in seqs] + [("d", "", n, "")])
        time.sleep(1.1)
    rows = decision_stream(spark, src).select("case_id", F.lit("L1").alias("source"), "seq")
    out = run_folder(spark, "gaps")
    q = watch.gap_stream(rows).writeStream.format("parquet").option("path", out).option("checkpointLocation", run_folder(spark, "ck")).trigger(availableNow=True).start()
    q.awaitTermination()
    changes = spark.read.schema(watch.GAPS).parquet(out)
    got = sorted((r.case_id, r.expected_seq, r.found_seq, r.missing) for r in watch.open_gaps(changes).collect())
    assert got == [("c", 5, 8, 3), ("c", 11, 13, 2), ("c", 16, 20, 4), ("c", 22, 25, 3), ("c", 26, 30, 4)]
    assert changes.filter("sign < 0").count() > 0  # gaps were taken back


def test_gaps_of_one_key_are_many_states(spark, tmp_path):
    """Ranges of ten ordinals, interleaved over batches, below zero too, with holes over whole ranges and nulls."""
    watch.use_rocksdb(spark)
    rng, src = random.Random(6), tmp_path / "in"
    seqs = rng.sample([*range(-40, 160), *range(400, 420)], 150)
    for n in range(4):
        land(src, n, [("c", "", s, "") for s in [*seqs[n::4], None]])
        time.sleep(1.1)
    rows = decision_stream(spark, src).select("case_id", F.lit("L1").alias("source"), "seq")
    out = run_folder(spark, "gaps")
    q = watch.gap_stream(rows, width=10).writeStream.format("parquet").option("path", out).option("checkpointLocation", run_folder(spark, "ck")).trigger(availableNow=True).start()
    q.awaitTermination()
    changes = spark.read.schema(watch.GAPS).parquet(out)
    order = sorted(seqs)
    want = [(a + 1, b, b - a - 1) for a, b in zip(order, order[1:]) if b - a > 1]
    assert sorted((r.expected_seq, r.found_seq, r.missing) for r in watch.open_gaps(changes).collect()) == want
    assert changes.select("range").distinct().count() == len({s // 10 for s in seqs})


def test_state_reads_few_runs_after_many_batches(spark):
    """Fifty batches: the state is right at any time, a repeated or half-written batch does no harm, few files are read."""
    rng, path, want = random.Random(9), run_folder(spark, "state"), {}
    for n in range(50):
        rows = [("c", f"k{rng.randrange(30)}", rng.randrange(10_000), f"v{n}-{i}") for i in range(5)]
        df = spark.createDataFrame(rows, "case_id string, ref string, seq bigint, decision string").coalesce(1)
        for again in range(1 + (n % 7 == 0)):
            state_table.add_run(df, n, path, ["case_id", "ref"], "seq")
        for _, ref, seq, value in rows:
            if seq > want.get(ref, (-1, ""))[0]:
                want[ref] = (seq, value)
        if n % 12 == 0 or n == 49:
            state = state_table.read_state(spark, path, ["case_id", "ref"], "seq")
            assert {r.ref: r.seq for r in state.collect()} == {k: s for k, (s, _) in want.items()}
    runs = state_table.live(spark, path)
    assert len(runs) <= 9 and sum(last - first + 1 for _, first, last in runs) == 50
    assert len(state_table.read_state(spark, path, ["case_id", "ref"], "seq").inputFiles()) <= 9 * 8
    assert len(os.listdir(path)) <= 20  # merged runs do not stay for good
    os.remove(f"{path}/level={runs[0][0]}-{runs[0][1]}-{runs[0][2]}/_SUCCESS")  # a run that was not committed
    assert runs[0] not in state_table.live(spark, path)


@given(st.lists(st.sets(st.integers(-20, 20), min_size=1, max_size=8), min_size=1, max_size=6))
def test_holes_of_any_order(parts):
    held, ends, seen = np.empty((0, 2), np.int64), None, set()
    for part in parts:
        seqs = np.array(sorted(part), np.int64)
        ends = ends or (int(seqs[0]), int(seqs[0]))
        closed, opened = watch.changed_holes(held, ends, seqs)
        left = {tuple(h) for h in held.tolist()} - {tuple(h) for h in closed.tolist()}
        held = np.array(sorted(left | {tuple(h) for h in opened.tolist()}), np.int64).reshape(-1, 2)
        ends = min(ends[0], int(seqs[0])), max(ends[1], int(seqs[-1]))
        seen |= part
        order = sorted(seen)
        assert held.tolist() == [[a + 1, b] for a, b in zip(order, order[1:]) if b - a > 1]


def test_silence_is_reported(spark, tmp_path):
    watch.use_rocksdb(spark)
    src = tmp_path / "in"
    land(src, 0, [("c", "", 1, "")])
    rows = decision_stream(spark, src).select("case_id", F.lit("L1").alias("source"), "seq")
    out = run_folder(spark, "silence")
    q = watch.silence_stream(rows, limit_ms=1500).writeStream.format("parquet").option("path", out).option("checkpointLocation", run_folder(spark, "ck")).trigger(processingTime="1 second").start()
    try:
        for _ in range(40):
            time.sleep(1)
            found = spark.read.schema(watch.SILENCE).option("ignoreMissingFiles", "true").parquet(out).count() if (q.lastProgress and q.lastProgress["batchId"] > 0) else 0
            if found:
                break
    finally:
        q.stop()
    assert [(r.case_id, r.kind, r.silent_ms) for r in spark.read.schema(watch.SILENCE).parquet(out).collect()] == [("c", "silent", 1500)]


def test_progress(spark):
    df, seen = progress.observed(spark.range(10).withColumn("e", F.when(F.col("id") > 7, "x")), error=F.col("e"))
    df.write.format("noop").mode("overwrite").save()
    assert seen.get == {"processed": 10, "errors": 2}
    assert progress.eta(5, 10, 2.5) == {"rate_per_s": 2.0, "eta_s": 2.5}
    assert progress.eta(0, 10, 0.0)["eta_s"] is None
