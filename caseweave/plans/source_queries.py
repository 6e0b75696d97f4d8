"""Readers, sinks and the raw feed: whole tables are written to the shared folder in a log's form and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..session import run_folder
from ..sources import artefacts, jsonl, sinks
from ..streaming import feed
from . import standins as st
from .integrity_queries import PROJECTED, _raw_events
from .registry import query

ROW = "case_id string, ref string, seq bigint"

#: Every event as a line: each tenth lacks its end, each tenth is blank, each tenth is an array, some are long.
LINES = (
    "with e as (select event_id, user_id, event_id % 10 as r from events), l as (select event_id, user_id, r, "
    "'{\"case_id\":\"u' || user_id || '\",\"ref\":\"doc-' || event_id || '\",\"seq\":' || event_id as head from e), "
    "lines as (select event_id, user_id, r, case r when 0 then head when 1 then '  ' when 2 then '[' || event_id || ']' "
    "when 3 then head || ',\"pad\":\"' || repeat('x', 200) || '\"}' else head || '}' end as line from l) "
)


def _lines(spark, d):
    e, r = st.table(spark, d, "events"), F.col("event_id") % 10
    head = F.format_string('{"case_id":"u%s","ref":"doc-%s","seq":%s', *(F.col(c).cast("string") for c in ("user_id", "event_id", "event_id")))
    padded = F.concat(head, F.lit(',"pad":"' + "x" * 200 + '"}'))
    array = F.concat(F.lit("["), F.col("event_id").cast("string"), F.lit("]"))
    line = F.when(r == 0, head).when(r == 1, "  ").when(r == 2, array).when(r == 3, padded).otherwise(F.concat(head, F.lit("}")))
    return e.select("event_id", r.alias("r"), line.alias("value"))


def _landed(spark, rows, folder="case-1/audit/log.jsonl"):
    path = f"{run_folder(spark, 'log')}/{folder}"
    rows.select("value").write.text(path)
    return path


@query("lenient_lines", LINES + "select 'u' || user_id as case_id, 'doc-' || event_id as ref, event_id as seq from lines where r > 2")
def lenient_lines(spark, d):
    """Lines that cannot be read and blank ones are skipped."""
    rows = _lines(spark, d).filter("r <> 2")
    return jsonl.read_lenient(spark, _landed(spark, rows), ROW)


@query(
    "audited_lines",
    LINES + "select case when r > 2 then event_id end as seq, case when r = 0 then line[1:120] end as parse_error from lines where r not in (1, 2)",
)
def audited_lines(spark, d):
    """Lines that cannot be read stay, as the start of their text."""
    rows, _ = jsonl.read_audited(spark, _landed(spark, _lines(spark, d).filter("r <> 2")), ROW)
    return rows.select(F.when(F.col("parse_error").isNull(), F.col("seq")).alias("seq"), "parse_error")


@query("strict_lines", LINES + "select 'u' || user_id as case_id, 'doc-' || event_id as ref, event_id as seq from lines where r > 2")
def strict_lines(spark, d):
    """A file in which every line has all fields; a line without them stops the job (tests)."""
    return jsonl.read_strict(spark, _landed(spark, _lines(spark, d).filter("r > 2")), ROW, ["case_id", "ref", "seq"])


NUMBERED = LINES + ", n as (select *, row_number() over (partition by event_id // 1000 order by event_id) as line_number from lines) "


@query(
    "numbered_lines",
    NUMBERED + "select 'case-1' as case_id, line_number, case when r > 2 then event_id end as id, case when r = 0 then line[1:120] end as decode_error from n where r not in (1, 2)",
)
def numbered_lines(spark, d):
    """Line numbers count blank lines and follow each file; a file holds a thousand events."""
    rows = _lines(spark, d).withColumn("value", F.when(F.col("r") == 2, "  ").otherwise(F.col("value")))
    path = f"{run_folder(spark, 'log')}/case-1/audit/log.jsonl"
    rows = rows.withColumn("file", F.floor(F.col("event_id") / 1000)).repartition("file")
    rows.sortWithinPartitions("file", "event_id").select("value", "file").write.partitionBy("file").text(path)
    found = jsonl.read_numbered(spark, path, "ref string, seq_in bigint").drop("seq_in")
    number = F.regexp_extract("ref", r"(\d+)$", 1)
    return found.select(
        "case_id", F.col("seq").alias("line_number"), F.when(F.col("decode_error").isNull(), number).cast("bigint").alias("id"), "decode_error"
    )


@query(
    "defensive_lines",
    LINES + "select case when r > 3 then event_id end as seq, case r when 0 then 'malformed' when 2 then 'not_object' when 3 then 'oversize' end as reject_reason, "
    "case when r < 4 then length(line) end as size from lines where r <> 1",
)
def defensive_lines(spark, d):
    """Usable rows, and with their reason those that went to quarantine; lines over 150 bytes are too long here."""
    good, bad = jsonl.read_defensive(spark, _landed(spark, _lines(spark, d)), "ref string", cap=150)
    number = F.regexp_extract("ref", r"(\d+)$", 1).cast("bigint")
    kept = good.select(number.alias("seq"), F.lit(None).cast("string").alias("reject_reason"), F.lit(None).cast("long").alias("size"))
    return kept.unionByName(bad.select(F.lit(None).cast("long").alias("seq"), "reject_reason", F.col("size").cast("long").alias("size")))


@query("register_files", "select 'case-1' as case_id, 'doc-' || doc_id as ref, lang || '.txt' as filename, sha256(text) as hash, n_chars > 500 as long_text from documents")
def register_files(spark, d):
    """Register files of five hundred entries each, every file one JSON array over several lines."""
    docs = st.table(spark, d, "documents").select(
        F.floor(F.col("doc_id") / 500).alias("file"), F.concat(F.lit("doc-"), "doc_id").alias("ref"), F.concat("lang", F.lit(".txt")).alias("filename"),
        F.sha2("text", 256).alias("hash"), F.when(F.col("n_chars") > 500, "long").otherwise("short").alias("notes"),
    )
    entry = F.to_json(F.struct("ref", "filename", "hash", "notes"))
    files = docs.groupBy("file").agg(F.collect_list(entry).alias("e"))
    path = f"{run_folder(spark, 'register')}/case-1/working/register.json"
    body = F.concat(F.lit("[\n"), F.array_join("e", ",\n"), F.lit("\n]"))
    files.select(body.alias("value"), "file").repartition("file").write.partitionBy("file").text(path)
    found = artefacts.read_register(spark, path)
    return found.select("case_id", "ref", "filename", "hash", (F.col("notes") == "long").alias("long_text"))


@query(
    "snapshot_sections",
    """select source as case_id, 'funnel' as section, cast(3 as bigint) as seq, '{"chars":' || sum(n_chars) || '}' as payload from documents group by 1
    union all select source, 'scale', cast(2 as bigint), '{"docs":' || count(*) || '}' from documents group by 1""",
)
def snapshot_sections(spark, d):
    """Three appended sections; the newer figures of one replace its older ones and leave the other alone."""
    docs, path = st.table(spark, d, "documents").groupBy(F.col("source").alias("case_id")), run_folder(spark, "snapshot")
    parts = [("funnel", F.count(F.lit(1)).alias("chars")), ("scale", F.count(F.lit(1)).alias("docs")), ("funnel", F.sum("n_chars").alias("chars"))]
    for seq, (section, figure) in enumerate(parts, 1):
        sinks.append_log(sinks.snapshot_rows(docs.agg(figure), section, F.lit(seq).cast("long"), F.lit("now")), path)
    return sinks.read_snapshot(spark.read.parquet(path)).select("case_id", "section", "seq", "payload")


@query(
    "artefact_replacement",
    """select source as case_id, 'doc-' || doc_id as ref, case when source < 'src3' then n_chars * 2 else n_chars end as n, case when source < 'src3' then 'second' else 'first' end as upstream_hash from documents""",
)
def artefact_replacement(spark, d):
    """An artefact of all cases, then anew for some: the other cases keep their rows and their stamp."""
    path = run_folder(spark, "artefact")
    rows = st.table(spark, d, "documents").select(F.col("source").alias("case_id"), F.concat(F.lit("doc-"), "doc_id").alias("ref"), F.col("n_chars").alias("n"))
    sinks.replace_artefact(sinks.stamped(rows, "first"), path)
    sinks.replace_artefact(sinks.stamped(rows.filter("case_id < 'src3'").withColumn("n", F.col("n") * 2), "second"), path)
    return spark.read.parquet(path).select(F.col("case_id").cast("string").alias("case_id"), "ref", "n", "upstream_hash")


@query(
    "collected_logs",
    """select 'case-1' as case_id, 'scope_recheck.jsonl' as source, 'doc-' || doc_id as ref, lang as verdict, cast(null as varchar) as stage from documents
    union all select 'case-2', 'llm_calls.jsonl', null, null, event_type from events""",
)
def collected_logs(spark, d):
    """Logs of several cases and kinds under one root in one table; lines that cannot be read are skipped."""
    root = run_folder(spark, "cases")
    docs = st.table(spark, d, "documents").select(F.to_json(F.struct(F.concat(F.lit("doc-"), "doc_id").alias("ref"), F.col("lang").alias("verdict"))).alias("value"))
    docs.unionByName(docs.select(F.lit("{cut").alias("value"))).write.text(f"{root}/case-1/working/scope_recheck.jsonl")
    st.table(spark, d, "events").select(F.to_json(F.struct(F.col("event_type").alias("stage"))).alias("value")).write.text(f"{root}/case-2/audit/llm_calls.jsonl")
    return artefacts.collect_logs(spark, root).select("case_id", "source", "ref", "verdict", "stage")


TOO_LONG = "event_id % 20000 = 7"


@query(
    "raw_feed",
    f"with p as ({PROJECTED}) select 'case-1' as case_id, kind, source, case when {TOO_LONG} then '<typeerror>' else ts end as ts, "
    f"case when not {TOO_LONG} then event_type end as event_type, case when not {TOO_LONG} then stage end as stage, "
    f"case when not {TOO_LONG} and event_type is not null then severity end as severity, "
    f"case when {TOO_LONG} then '(unrecognised event type)' else summary end as summary from p",
)
def raw_feed(spark, d):
    """Raw lines of two sources in three dialects through the live projection, stopped and resumed on one checkpoint.

    Half of the files land after the first run has ended. Lines over the cap are passed on as a marker only.
    """
    root = run_folder(spark, "feed")
    out, check = f"{root}/out", f"{root}/check"
    e = st.table(spark, d, "events").select(*_raw_events())
    dialect = F.col("event_id") % 3
    stamp = F.when(dialect == 1, "timestamp").otherwise("ts")
    kind = F.when(dialect == 0, "event_type").when(dialect == 1, "event").otherwise("template_id")
    pad = F.when(F.expr(TOO_LONG), F.repeat(F.lit("x"), feed.LINE_CAP)).otherwise("")
    line = F.concat(
        F.lit('{"'), stamp, F.lit('":"'), F.col("ts"), F.lit('","'), kind, F.lit('":"'), F.col("event_type"), F.lit('","payload":'), F.col("payload"),
        F.lit(',"pad":"'), pad, F.lit('"}'),
    )
    lines = e.select("source", "event_id", line.alias("value"))
    sources = {name: f"{root}/case-1/audit/{name}" for name in ("L1", "L3")}
    for turn in (0, 1):
        for name, path in sources.items():
            part = lines.filter((F.col("source") == name) & (F.col("event_id") % 2 == turn))
            part.select("value").write.mode("append").text(path)
        rows = feed.live_projection(spark, sources)
        rows.writeStream.format("parquet").option("checkpointLocation", check).option("path", out).trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(out).select("case_id", "kind", "source", "ts", "event_type", "stage", "severity", "summary")


FILES = LINES + ", f as (select event_id // 1000 as part, string_agg(line, chr(10) order by event_id) || chr(10) as body from lines group by 1) "


def _files(spark, d, folder):
    """Text files of a thousand events each, in the order of their ids."""
    path = f"{run_folder(spark, 'files')}/{folder}"
    rows = _lines(spark, d).withColumn("part", F.floor(F.col("event_id") / 1000)).repartition("part")
    rows.sortWithinPartitions("part", "event_id").select("value", "part").write.partitionBy("part").text(path)
    return path


@query("source_tree", FILES + "select 'part=' || part as folder, cast(length(body) as bigint) as length, sha256(body) as digest from f")
def source_tree(spark, d):
    """Size and digest of every file under a tree."""
    root = _files(spark, d, "case-1/source")
    found = artefacts.read_file_hashes(spark, root).filter(F.col("path").endswith(".txt"))
    return found.select(F.regexp_extract("path", r"^([^/]+)/", 1).alias("folder"), "length", "digest")


@query("text_files", FILES + "select 'case-1' as case_id, length(body) as n_chars, sha256(body) as digest from f")
def text_files(spark, d):
    """Extracted texts, one file each."""
    texts = artefacts.read_texts(spark, _files(spark, d, "case-1/working/texts") + "/*/*.txt")
    return texts.select("case_id", F.char_length("text").cast("long").alias("n_chars"), F.sha2("text", 256).alias("digest"))


@query(
    "tag_files",
    """select 'case-1' as case_id, 'file-' || doc_id // 500 as ref, lang as text, doc_id as start, case when lang = 'de' then null else doc_id + 2 end as "end",
    case lang when 'en' then 'redact' when 'fr' then 'preserve' else 'flag' end as redact from documents""",
)
def tag_files(spark, d):
    """Tag files of five hundred entities, one JSON object over several lines each; offsets that are no numbers become null."""
    lang, at = F.col("lang"), F.col("doc_id").cast("string")
    redact = F.when(lang == "en", "true").when(lang == "fr", "false").otherwise('"flag"')
    end = F.when(lang == "de", '"unknown"').otherwise((F.col("doc_id") + 2).cast("string"))
    entity = F.concat(F.lit('{"text":"'), lang, F.lit('","redact":'), redact, F.lit(',"start":'), at, F.lit(',"end":'), end, F.lit("}"))
    docs = st.table(spark, d, "documents").select(F.floor(F.col("doc_id") / 500).alias("part"), entity.alias("entity"))
    files = docs.groupBy("part").agg(F.array_join(F.collect_list("entity"), ",\n").alias("e"))
    body = F.concat(F.lit('{"ref":"file-'), F.col("part").cast("string"), F.lit('",\n"entities":[\n'), F.col("e"), F.lit("\n]}"))
    path = f"{run_folder(spark, 'tags')}/case-1/working/tags"
    files.select(body.alias("value"), "part").repartition("part").write.partitionBy("part").text(path)
    found = artefacts.read_tags(spark, path).select("case_id", "ref", F.explode("entities").alias("e"))
    return found.select("case_id", "ref", "e.text", F.col("e.start").cast("long").alias("start"), F.col("e.end").cast("long").alias("end"), "e.redact")
