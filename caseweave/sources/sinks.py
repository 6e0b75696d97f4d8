"""Artefact writes: provenance-stamped replacement, append-only logs, snapshot sections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import PRODUCER_VERSION, SCHEMA_VERSION
from ..operators.latest import latest_per_key


def stamped(df: DataFrame, upstream_hash: Column | str) -> DataFrame:
    """Every row with the digest of what it was made from and the versions that made it."""
    value = F.lit(upstream_hash) if isinstance(upstream_hash, str) else upstream_hash
    return df.withColumns(
        {
            "upstream_hash": value,
            "schema_version": F.lit(SCHEMA_VERSION),
            "producer_version": F.lit(PRODUCER_VERSION),
        }
    )


def replace_artefact(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Replace the given cases of an artefact and leave other cases alone."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("case_id").format(fmt).save(path)


def append_log(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Append rows to a log. Rows must carry `seq`, the order in which they were made."""
    if "seq" not in df.columns:
        raise ValueError("log rows need a seq column")
    df.write.mode("append").format(fmt).save(path)


def snapshot_rows(metrics: DataFrame, section: str, seq: Column, computed_at: Column) -> DataFrame:
    """One snapshot section per case as appendable rows."""
    body = F.to_json(F.struct(*[c for c in metrics.columns if c != "case_id"]))
    return metrics.select(
        "case_id", F.lit(section).alias("section"), seq.alias("seq"), computed_at.alias("computed_at"), body.alias("payload")
    )


def read_snapshot(rows: DataFrame) -> DataFrame:
    """Latest state of every section; writing one leaves the others as they were."""
    return latest_per_key(rows, ["case_id", "section"]).drop("n_rows")
