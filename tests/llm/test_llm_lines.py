"""Line deduplication against plain Python."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from caseweave.llm import line_runs, queries

BLANKS = " \t\n\x0b\x0c\r"


def key_of(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(BLANKS))


def brute(rows, least=10):
    """(lines, dropped, kept text) of each (id, text); rows without an id are one last document."""
    place = lambda i: 2**63 - 1 if i is None else i
    holders = {}
    for i, text in rows:
        for line in (text or "").split("\n"):
            holders.setdefault(key_of(line), set()).add(place(i))
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        keys = [key_of(x) for x in lines]
        kept = [x for x, k in zip(lines, keys, strict=True) if len(k) < least or min(holders[k]) == place(i)]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def found(df):
    return sorted(((r["doc_id"], r["n_lines"], r["n_dropped"], r["kept_text"]) for r in df.collect()), key=repr)


def test_query_against_plain_python(spark, sf):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    want = {i: (n, d, hashlib.sha256(t.encode()).hexdigest()) for i, n, d, t in brute(rows)}
    got = queries.op11_line_dedup(spark, sf).collect()
    assert {r["doc_id"]: (r["n_lines"], r["n_dropped"], r["kept_sha256"]) for r in got} == want and len(got) == len(rows)
    assert sum(d for _, d, _ in want.values()) > 0


@pytest.mark.parametrize(("batches", "fanout"), [(1, 2), (3, 2), (7, 3)])
def test_random_lines(spark, batches, fanout):
    """Few distinct lines in many documents, with blanks, capitals, other letters, nulls, twins and repeated rows."""
    rng = random.Random(batches)
    pool = [f"the line number {i} of all" for i in range(30)] + ["short", "", " \t ", "ÀÉ İstanbul ΣΑΣ line", "àé i̇stanbul σασ line", "x" * 9, "x" * 10]
    dress = lambda t: rng.choice([t, t.upper() if t.isascii() else t, f"  {t}\t", f"{t}\r", f"\x0b{t}\x0c", f"\x1c{t}"])
    rows = []
    for i in range(300):
        text = "\n".join(dress(rng.choice(pool)) for _ in range(rng.randrange(8)))
        rows.append((rng.choice([i, i, i, i - 1, None]), rng.choice([text, text, text, None])))
    rows += rows[:20] + [(1000, "\n".join(f"long text line {i % 4000}" for i in range(20_000))), (1001, "long text line 7\nLONG TEXT LINE 3999")]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, n_lines int, pos string").repartition(5)
    assert found(line_runs.dedup_lines(df, batches=batches, fanout=fanout)) == brute(rows)
    assert found(line_runs.dedup_lines(df, batches=batches, fanout=fanout, carry=("pos",)).drop("pos")) == brute(rows)
    with pytest.raises(ValueError):
        line_runs.dedup_lines(df, carry=("n_lines",))


def test_hot_lines_are_split(spark, monkeypatch):
    """With every shared line hot, with none, and with some."""
    rows = [(i, f"everyone has this line\nonly some have this {i % 50}\nnobody else has this {i}") for i in range(2000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    want = brute(rows)
    for least in (1, 100, 10**6):
        monkeypatch.setattr(line_runs, "HOT_LINES", least)
        assert found(line_runs.dedup_lines(df)) == want


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert line_runs.dedup_lines(df).collect() == []


def test_runs_take_batches_as_they_come(spark):
    """Runs stay few, disjoint and sorted, and a later batch only gets what no run holds."""
    runs, seen = line_runs.LineRuns(spark, fanout=3), set()
    rng = random.Random(5)
    for k in range(10):
        values = [rng.randrange(400) for _ in range(120)]
        lines = spark.createDataFrame([(v, -v, 1000 * k + i) for i, v in enumerate(values)], "h1 long, h2 long, place long")
        new = {r["h1"] for r in runs.admit(lines).filter("owner is not null").collect()}
        assert new == set(values) - seen
        seen |= new
        held = [r["h1"] for r in runs.held().collect()]
        assert len(held) == len(set(held)) and set(held) == seen
        assert all(len(level) < 3 for level in runs.levels)
    assert sum(map(len, runs.levels)) <= 6
    for run in (r for level in runs.levels for r in level):
        rows = run.select(F.input_file_name().alias("f"), F.monotonically_increasing_id().alias("at"), "h1", "h2").collect()
        for file in {r["f"] for r in rows}:
            own = [(r["h1"], r["h2"]) for r in sorted((r for r in rows if r["f"] == file), key=lambda r: r["at"])]
            assert own == sorted(own)
