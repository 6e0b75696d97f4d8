"""Append-only logs read as current state: the row with the highest ordinal per key wins.

All of these are aggregates that combine before the shuffle, so a key holding a large
share of the log costs one partial row per map task rather than one huge window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _pick(df: DataFrame, keys: list[str], chosen: Column) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    return (
        df.groupBy(*keys)
        .agg(chosen.alias("row_"), F.count(F.lit(1)).alias("n_rows"))
        .select(*keys, *[F.col(f"row_.{c}").alias(c) for c in rest], "n_rows")
    )


def latest_per_key(df: DataFrame, keys: list[str], seq: str = "seq") -> DataFrame:
    """Last appended row per key, with the number of rows the key had. Blank keys are dropped."""
    for key in keys:
        df = df.filter(F.col(key).isNotNull() & (F.col(key).cast("string") != ""))
    rest = [c for c in df.columns if c not in keys]
    return _pick(df, keys, F.max_by(F.struct(*rest), F.col(seq)))


def first_per_key(df: DataFrame, keys: list[str], seq: str = "seq") -> DataFrame:
    """First row per key; `n_rows` above one tells of a collision. Blank keys are dropped."""
    for key in keys:
        df = df.filter(F.col(key).isNotNull() & (F.col(key).cast("string") != ""))
    rest = [c for c in df.columns if c not in keys]
    return _pick(df, keys, F.min_by(F.struct(*rest), F.col(seq)))


def latest_row(df: DataFrame, case: str = "case_id", seq: str = "seq") -> DataFrame:
    """The single latest row of each case."""
    return latest_per_key(df, [case], seq).drop("n_rows")


def recent_kinds(events: DataFrame, n: int = 3, kind: str = "stage", seq: str = "seq") -> DataFrame:
    """The last n decision kinds of each case, newest first.

    `row_number <= n` is limited inside every map task first, so the ordered list
    built afterwards never holds more than n values.
    """
    newest = Window.partitionBy("case_id").orderBy(F.desc(seq))
    top = (
        events.filter(F.coalesce(F.col(kind), F.lit("")) != "")
        .select("case_id", F.col(kind).alias("kind"), seq)
        .withColumn("rn", F.row_number().over(newest))
        .filter(F.col("rn") <= n)
    )
    ordered = F.array_sort(F.collect_list(F.struct("rn", "kind")))
    return top.groupBy("case_id").agg(F.transform(ordered, lambda r: r["kind"]).alias("recent"))


def with_latest(rows: DataFrame, decisions: DataFrame, keys: list[str], default: str = "pending") -> DataFrame:
    """Rows with their latest decision; rows nobody decided read as `default`."""
    last = latest_per_key(decisions, keys).select(
        *keys, "decision", "reason_code", "note", F.col("ts").alias("decision_ts")
    )
    return rows.join(last, keys, "left").withColumns(
        {
            "decision": F.coalesce("decision", F.lit(default)),
            "reason_code": F.coalesce("reason_code", F.lit("")),
            "note": F.coalesce("note", F.lit("")),
            "decision_ts": F.coalesce("decision_ts", F.lit("")),
        }
    )
