"""JSON Lines readers, from forgiving to strict. The case id comes from the folder layout."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..schemas import CORRUPT


def case_of(path: Column, layout: str = r"/([^/]+)/(?:working|audit|output|source|redacted)/") -> Column:
    """Case id from a file path; the folder above the artefact folder by default."""
    return F.regexp_extract(path, layout, 1)


def _raw(spark: SparkSession, paths, schema: str) -> DataFrame:
    """Parsed non-blank lines with case id, file name and the raw text of lines that do not parse."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    lines = spark.read.option("ignoreMissingFiles", "true").text(paths).select(
        "value",
        case_of(F.col("_metadata.file_path")).alias("folder_case"),
        F.col("_metadata.file_name").alias("source"),
    )
    rows = lines.filter(F.trim("value") != "").select(
        F.from_json("value", f"{schema}, {CORRUPT} string", options).alias("row"), "folder_case", "source"
    )
    if _has_case(schema):
        return rows.select("row.*", "source")
    return rows.select("row.*", F.col("folder_case").alias("case_id"), "source")


def _has_case(schema: str) -> bool:
    return any(part.strip().startswith("case_id ") for part in schema.split(","))


def read_lenient(spark: SparkSession, paths, schema: str) -> DataFrame:
    """Rows that parse; blank and malformed lines are skipped. No matching file gives no rows."""
    paths = existing(spark, paths)
    if not paths:
        return spark.createDataFrame([], schema if _has_case(schema) else f"{schema}, case_id string")
    return _raw(spark, paths, schema).filter(F.col(CORRUPT).isNull()).drop(CORRUPT, "source")


def read_strict(spark: SparkSession, paths, schema: str, required: list[str]) -> DataFrame:
    """Rows of a file in which every line must parse and hold the required fields; else the job fails."""
    rows = _raw(spark, paths, schema)
    bad = F.col(CORRUPT).isNotNull()
    for name in required:
        bad = bad | F.col(name).isNull()
    message = F.concat(F.lit("malformed or incomplete row: "), F.substring(F.coalesce(F.col(CORRUPT), F.to_json(F.struct(*required))), 1, 200))
    checked = rows.withColumn("ok_", F.when(bad, F.raise_error(message).cast("boolean")).otherwise(F.lit(True)))
    return checked.filter("ok_").drop("ok_", CORRUPT, "source")


def read_audited(spark: SparkSession, paths, schema: str, cap: int = 5000) -> tuple[DataFrame, DataFrame]:
    """All rows, malformed ones as a parse error of their first 120 characters; plus a size report.

    Nothing is dropped past `cap` rows: the report says which files are longer.
    """
    rows = _raw(spark, paths, schema).withColumn("parse_error", F.substring(CORRUPT, 1, 120)).drop(CORRUPT)
    sizes = rows.groupBy("case_id", "source").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("parse_error").alias("n_malformed")
    )
    return rows, sizes.withColumn("over_cap", F.col("n_rows") > cap)


def read_lines(spark: SparkSession, paths) -> DataFrame:
    """Text lines with case, file and a per-file ordinal that follows the order of the file.

    The ordinal is the count of lines in earlier blocks of the file plus the place in its own
    block. Block sizes are counted first; only those few counts are put in order.
    """
    # one row per line; the monotonic id grows with the place inside a split, and the block start
    # orders the splits of a file
    rows = spark.read.text(paths).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("mid"),
    )
    blocks = rows.groupBy("file", "block").agg(F.min("mid").alias("first"), F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("offset", F.coalesce(F.sum("n").over(before), F.lit(0)))
    return rows.join(blocks.select("file", "block", "first", "offset"), ["file", "block"], "inner").select(
        case_of(F.col("file")).alias("case_id"),
        F.regexp_extract("file", r"([^/]+)$", 1).alias("source"),
        (F.col("offset") + F.col("mid") - F.col("first") + 1).alias("seq"),
        "value",
    )


def read_numbered(spark: SparkSession, paths, schema: str) -> DataFrame:
    """Parsed rows with their line number; a line that does not parse keeps its error."""
    lines = read_lines(spark, paths).filter(F.trim("value") != "")
    body = F.from_json("value", f"{schema}, {CORRUPT} string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    rows = lines.withColumn("row", body)
    return rows.select(
        "case_id", "source", "seq", F.substring(f"row.{CORRUPT}", 1, 120).alias("decode_error"), "row.*"
    ).drop(CORRUPT)


def classify_lines(lines: DataFrame, cap: int = 1024 * 1024) -> DataFrame:
    """Why a line cannot be used: oversize, not UTF-8, malformed, not an object; null when it can.

    lines: a binary or string column `value`. Blank lines are dropped.
    """
    raw = F.col("value").cast("binary")
    text = F.try_validate_utf8(F.col("value").cast("string"))
    rows = lines.withColumns({"text": text, "size": F.octet_length(raw)})
    parsed = F.try_parse_json(F.col("text"))
    reason = (
        F.when(F.col("size") > cap, "oversize")
        .when(F.col("text").isNull(), "not_utf8")
        .when(parsed.isNull(), "malformed")
        .when(~F.startswith(F.trim("text"), F.lit("{")), "not_object")
    )
    return rows.filter(F.coalesce(F.trim("text"), F.lit("x")) != "").withColumn("reject_reason", reason)


def read_defensive(spark: SparkSession, paths, schema: str, cap: int = 1024 * 1024) -> tuple[DataFrame, DataFrame]:
    """Usable rows, and the rejected lines with their reason (the quarantine)."""
    lines = classify_lines(read_lines(spark, paths), cap)
    good = lines.filter("reject_reason is null").withColumn("row", F.from_json("text", schema))
    return (
        good.select("case_id", "source", "seq", "row.*"),
        lines.filter("reject_reason is not null").select("case_id", "source", "seq", "reject_reason", "size"),
    )


def existing(spark: SparkSession, paths) -> list[str]:
    """The paths and globs that match at least one file."""
    jvm = spark._jvm
    conf = spark._jsc.hadoopConfiguration()
    out = []
    for p in [paths] if isinstance(paths, str) else paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        found = path.getFileSystem(conf).globStatus(path)
        if found is not None and len(found) > 0:
            out.append(p)
    return out
