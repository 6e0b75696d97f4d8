"""Readers for registers, tag files, texts, binary trees and whole case logs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions import hashing, spans
from .jsonl import case_of, existing, read_lenient


def read_register(spark: SparkSession, paths) -> DataFrame:
    """Register files: one JSON array each. A file that holds anything else stops the job."""
    raw = spark.read.text(paths, wholetext=True).withColumn("case_id", case_of(F.col("_metadata.file_path")))
    is_array = F.rlike("value", F.lit(r"(?s)^\s*\[.*\]\s*$"))
    rows = F.from_json("value", f"array<struct<{_struct(schemas.REGISTER)}>>", {"mode": "FAILFAST"})
    checked = F.when(is_array, rows).otherwise(F.raise_error("register is not a JSON array"))
    return raw.select("case_id", F.explode(checked).alias("r")).select("case_id", "r.*")


def _struct(schema: str) -> str:
    """DDL column list as struct fields (nested commas left alone)."""
    out, depth = [], 0
    for ch in schema:
        depth += (ch in "<(") - (ch in ">)")
        out.append("\n" if ch == "," and depth == 0 else ch)
    fields = "".join(out).split("\n")
    return ",".join(":".join(f.strip().split(" ", 1)) for f in fields)


def read_tags(spark: SparkSession, paths, strict: bool = False) -> DataFrame:
    """Tag files, one JSON object each; the ref comes from the payload or from the file name.

    Unreadable files are skipped, or stop the job when `strict`. The mixed redact field is read as
    text and normalised; offsets that are not numbers become null.
    """
    options = {"multiLine": "true", "mode": "FAILFAST" if strict else "PERMISSIVE"}
    schema = schemas.TAGS if strict else f"{schemas.TAGS}, {schemas.CORRUPT} string"
    reader = spark.read.schema(schema).options(columnNameOfCorruptRecord=schemas.CORRUPT, **options)
    rows = reader.json(paths).withColumns(
        {
            "case_id": case_of(F.col("_metadata.file_path")),
            "file_ref": F.regexp_extract(F.col("_metadata.file_name"), r"^(.*)_tags\.json$", 1),
        }
    )
    if not strict:
        rows = rows.filter(F.col(schemas.CORRUPT).isNull()).drop(schemas.CORRUPT)
    entities = F.transform(
        F.coalesce("entities", F.expr("cast(array() as array<struct<text:string,type:string,label:string,source:string,classification:string,redact:string,start:string,end:string>>)")),
        lambda e: F.struct(
            e["start"].try_cast("int").alias("start"),
            e["end"].try_cast("int").alias("end"),
            F.coalesce(e["text"], F.lit("")).alias("text"),
            e["type"].alias("type"),
            e["source"].alias("source"),
            F.coalesce(e["classification"], F.lit("")).alias("classification"),
            spans.redact_state(e["redact"]).alias("redact"),
        ),
    )
    ref = F.when(F.coalesce("ref", F.lit("")) != "", F.col("ref")).otherwise(F.col("file_ref"))
    return rows.select("case_id", ref.alias("ref"), "filename", entities.alias("entities"))


def read_texts(spark: SparkSession, paths) -> DataFrame:
    """Extracted texts, one file per document, undecodable bytes replaced."""
    raw = spark.read.format("binaryFile").load(paths)
    text = F.make_valid_utf8(F.col("content").cast("string"))
    return raw.select(
        case_of(F.col("path")).alias("case_id"), F.regexp_extract("path", r"([^/]+)\.txt$", 1).alias("ref"), text.alias("text")
    )


def read_file_hashes(spark: SparkSession, root: str) -> DataFrame:
    """Every file under a tree with its relative path, size and SHA-256."""
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    plain = F.regexp_replace(F.col("path"), r"^file:(//)?", "")
    base = root.rstrip("/").removeprefix("file:")
    return raw.select(
        F.substring(plain, len(base) + 2, 1_000_000).alias("path"), "length", F.sha2("content", 256).alias("digest")
    )


LOGS = {
    "pipeline.jsonl": schemas.PIPELINE_LOG,
    "llm_calls.jsonl": "ts string, stage string, model_alias string, input_tokens bigint, output_tokens bigint",
    "verify_spec_findings.jsonl": "ref string, gate string, severity string, issue string",
    "post_bake_findings.jsonl": "ref string, page int, gate string, severity string, issue string",
    "scope_recheck.jsonl": "ref string, verdict string",
    "scope_rerank.jsonl": schemas.RERANK,
    "pii_collection.jsonl": "ref string, in_scope_recheck string",
}


def collect_logs(spark: SparkSession, root: str) -> DataFrame:
    """All logs of all cases under a root in one table with a `source` column; absent logs are empty."""
    parts = []
    for name, schema in LOGS.items():
        paths = existing(spark, [f"{root}/*/audit/{name}", f"{root}/*/working/{name}"])
        if paths:
            parts.append(read_lenient(spark, paths, schema).withColumn("source", F.lit(name)))
    if not parts:
        return spark.createDataFrame([], "case_id string, source string")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def content_hash(df: DataFrame, text: str = "text") -> DataFrame:
    return df.withColumn("hash", hashing.digest(F.col(text)))
