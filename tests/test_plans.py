"""Plan shape: what must hold at any size of data."""

import re

import pytest
from pyspark.sql import functions as F

from caseweave.operators import dedupe, latest
from caseweave.plans import standins as st
from caseweave.plans.catalogue import QUERIES

MODELS = {"rerank_shadow", "rerank_enforce", "reply_coercion", "context_coercion", "embed_documents", "text_clean"}
#: One walk with the automaton of all needles, which no expression does.
WALKS = {
    "needle_hits", "case_needles", "tag_build", "flag_clusters", "flag_cluster_refs", "pending_flags", "flag_resolution_bulk",
    "redaction_badges", "apply_redactions",
}
PYTHON_STAGES = MODELS | WALKS
PYTHON_NODE = re.compile(r"\w*(?:InPandas|InArrow|EvalPython|PythonUDTF|PythonRunner|PythonUDF)\w*")
WRITES = {"stream_projection", "stream_funnel", "stream_latest_decision", "stream_gaps"}
TOP_K = ["vector_search", "people_top_n", "recent_kinds", "first_findings", "walkthrough_sample", "calibration_sample", "next_best_review", "top_changes", "dual_juror"]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITES))
def test_no_cross_joins_and_python_only_for_models_and_walks(spark, sf, name):
    text = plan(QUERIES[name](spark, sf))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    found = set(PYTHON_NODE.findall(text))
    assert bool(found) == (name in PYTHON_STAGES), found


@pytest.mark.parametrize("name", TOP_K)
def test_top_k_is_limited_before_the_shuffle(spark, sf, name):
    text = plan(QUERIES[name](spark, sf))
    assert "WindowGroupLimit" in text and "Partial" in text


def test_dedupe_shuffles_hashes_once(spark, sf):
    docs = st.docs(spark, sf).select("case_id", "ref", F.sha2("text", 256).alias("hash"))
    found = dedupe.mark_duplicates(docs)
    found.collect()
    text = plan(found)
    assert "ReusedExchange" in text
    # the text is read, hashed and left behind: no exchange of the operator carries it
    for line in re.findall(r"Exchange hashpartitioning\(case_id.*", text):
        assert "text" not in line


def test_latest_combines_before_the_shuffle(spark, sf):
    text = plan(latest.latest_per_key(st.decisions(spark, sf), ["case_id", "ref"]))
    assert text.count("partial_max_by") >= 1 and "Window" not in text


def test_scans_are_pruned_and_filters_pushed(spark, sf):
    text = plan(st.docs(spark, sf).filter("n_chars > 3000").select("case_id", "ref"))
    assert re.search(r"PushedFilters: \[.*GreaterThan\(n_chars,3000\)", text)
    schema = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert "text" not in schema and "lang" not in schema


def test_letters_of_a_text_are_counted_without_an_array_of_them(spark, sf):
    """An array of all matches takes many times the bytes of a long text."""
    text = plan(QUERIES["text_quality_bands"](spark, sf))
    assert "regexp_replace" in text and "regexp_extract_all" not in text


def test_stand_in_model_answers_from_the_whole_text():
    """The limit of a rationale is the coercion's, not the model's."""
    import json

    from caseweave.plans.scope_queries import _reply

    text = "word " * 1000 + "end"
    reply = _reply()([text])[0]
    assert json.loads(reply[reply.index("{") : reply.rindex("}") + 1])["rationale"] == text


def test_every_python_node_is_seen(spark):
    """The test above must not be blind to a way of running Python."""
    import pyarrow as pa

    rows = spark.range(4).withColumn("g", F.col("id") % 2)
    same = lambda batches: batches
    plus = F.pandas_udf(lambda x: x + 1, "long")
    grouped = rows.groupBy("g")
    kept = lambda table: table
    both = lambda a, b: pa.concat_tables([a, b])
    plans = [
        rows.mapInPandas(same, rows.schema), rows.mapInArrow(same, rows.schema), rows.select(plus("id")),
        rows.select(F.udf(lambda x: x, "long")("id")), grouped.applyInPandas(kept, rows.schema), grouped.applyInArrow(kept, rows.schema),
        grouped.cogroup(rows.groupBy("g")).applyInPandas(both, rows.schema), grouped.cogroup(rows.groupBy("g")).applyInArrow(both, rows.schema),
    ]
    for df in plans:
        assert PYTHON_NODE.search(plan(df)), plan(df)
    assert not PYTHON_NODE.search(plan(grouped.count()))
