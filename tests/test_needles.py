"""Many needles in one walk, and running sums, against plain Python."""

import random
import re
import time

import pytest
from pyspark.sql import functions as F

from caseweave.functions import spans
from caseweave.operators import entities, needles
from caseweave.plans import standins as st


def folded(text):
    return text.replace("İ", "I").lower()


def starts_of(text, needle):
    out, at = [], 0
    while needle and (i := text.find(needle, at)) >= 0:
        out.append(i)
        at = i + len(needle)
    return out


@pytest.mark.parametrize("chunk", [1, 3, 512])
def test_running_sums(spark, monkeypatch, chunk):
    monkeypatch.setattr(spans, "CHUNK", chunk)
    rng = random.Random(chunk)
    rows = [([rng.randrange(9) for _ in range(n)],) for n in (0, 1, 2, 3, 4, 511, 512, 513, 1024, 1500)]
    df = spark.createDataFrame(rows, "v array<int>")
    for r in df.select("v", spans.running(F.col("v")).alias("s")).collect():
        want = [0]
        for x in r.v:
            want.append(want[-1] + x)
        assert r.s == want


def test_many_spans_take_linear_time(spark):
    """Four times the addresses: about four times the time, not sixteen."""
    took = []
    for n in (25_000, 100_000):
        df = spark.createDataFrame([("a@b.cd " * n,)], "text string").select(spans.pattern_spans(F.col("text"), r"[a-z]+@b\.cd", "k").alias("s"))
        best = 1e9
        for _ in range(2):
            t = time.perf_counter()
            r = df.first().s
            best = min(best, time.perf_counter() - t)
        assert len(r) == n and (r[-1].start, r[-1].end) == (7 * n - 7, 7 * n - 1)
        took.append(best)
    assert took[1] < 9 * took[0], took


def test_walk_finds_what_a_search_for_each_finds(spark):
    rng = random.Random(1)
    letters = ["a", "b", "ab", "A", "é", "😀", "İ", " ", "aa"]
    draw = lambda n: "".join(rng.choice(letters) for _ in range(n))
    rows = []
    for i in range(200):
        own = [draw(rng.randrange(4)) for _ in range(rng.randrange(12))]
        rows.append((i, draw(rng.randrange(60)), [*own, *own[:2], None]))
    rows += [(900, None, ["a"]), (901, "", ["a"]), (902, "abc", None), (903, "aaaa", ["aa", "AA", "a"])]
    df = spark.createDataFrame(rows, "id int, text string, n array<string>").withColumn("low", spans.folded(F.col("text"))).drop("text")
    low = F.transform("n", lambda n: F.struct(n.alias("value"), spans.folded(n).alias("low")))
    fixed = F.when(F.col("id") == 903, F.array(F.struct(F.lit(2).alias("start"), F.lit("aa").alias("text")), F.struct(F.lit(1).alias("start"), F.lit("aa").alias("text")), F.struct(F.lit(0).alias("start"), F.lit("b").alias("text"))))
    got = {r["id"]: r for r in needles.locate(df, "low", low, fixed).collect()}
    assert set(got) == {r[0] for r in rows} and "low" not in needles.locate(df, "low", low).columns
    for i, text, own in rows:
        seen = set()
        want = []
        for n in own or []:
            want.append([] if n is None or n in seen else starts_of(folded(text or ""), folded(n)))
            seen.add(n)
        assert got[i].starts == want
    assert got[903].fresh == [False, True, True]
    with pytest.raises(ValueError):
        needles.locate(df.withColumn("fresh", F.lit(1)), "low", low)


@pytest.mark.parametrize("size", [4 << 20, 40])
def test_needles_of_a_case(spark, monkeypatch, size):
    """In one slice and in many: the same spans; null and empty needles and texts give none."""
    monkeypatch.setattr(needles, "SLICE_BYTES", size)
    rng = random.Random(2)
    docs = [(f"c{i % 3}", f"d{i}", rng.choice([None, "", " ".join(rng.choice(["Anna", "ann", "Nan", "İs", "x"]) for _ in range(30))])) for i in range(60)]
    own = [("c0", "anna"), ("c0", "ANNA"), ("c0", "nn"), ("c1", "İs"), ("c1", ""), ("c1", None), ("c9", "x"), (None, "x"), ("c0", " "), ("c1", "nan x")]
    docs_df = spark.createDataFrame(docs, "case_id string, ref string, text string").withColumn("start", F.lit("x"))
    df = spark.createDataFrame(own, "case_id string, needle string")
    want = sorted(
        (c, r, n, s, s + len(n))
        for c, r, t in docs for n in {folded(n) for k, n in own if k == c and n} for s in starts_of(folded(t or ""), n)
    )
    got = needles.locate_in_cases(docs_df, df)
    assert sorted(map(tuple, got.collect())) == want and want
    assert needles.locate_in_cases(docs_df, df.limit(0)).collect() == []
    assert needles.locate_in_cases(docs_df.limit(0), df).collect() == []


def test_walk_does_not_grow_with_the_number_of_needles():
    text = " ".join(f"word{i % 5000}" for i in range(100_000))
    took = []
    for n in (50, 5000):
        automaton = needles.Automaton(f"other{i}" for i in range(n))
        t = time.perf_counter()
        assert automaton.starts(text) == {}
        took.append(time.perf_counter() - t)
    assert took[1] < 10 * took[0] + 0.05, took


def test_filter_on_cases_reaches_the_scan(spark, sf):
    text = st.tags(spark, sf, cases=["src1", "src2"])._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in text.splitlines() if "FileScan" in line]
    assert scans and all(re.search(r"PushedFilters: \[[^\]]*(In|EqualTo)\(source", line) for line in scans), scans
    some = {(r.case_id, r.ref): r.entities for r in st.tags(spark, sf, cases=["src1", "src2"]).collect()}
    every = {(r.case_id, r.ref): r.entities for r in st.tags(spark, sf).collect()}
    assert some == {k: v for k, v in every.items() if k[0] in ("src1", "src2")} and some


def test_contact_counts_read_each_pattern_once(spark, sf):
    """The spans of a document are found once, though five figures are made of them; a case filter reaches the scan."""
    counted = entities.contact_counts(st.docs(spark, sf)).filter("case_id = 'src1'")
    text = counted._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(source,src1)" in text and "rand(" not in text
    assert text.count("(?U)[A-Za-z0-9._%+-]+@") <= 4, text.count("(?U)[A-Za-z0-9._%+-]+@")
