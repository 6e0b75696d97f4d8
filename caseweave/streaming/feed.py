"""The live feed as Structured Streaming: merged log sources, projection, replay, running figures.

The file source reads whole new files: land logs as rolled segments (or read them from Kafka).
Resuming after a stop is the checkpoint's job.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources.jsonl import case_of
from . import state_table
from .projection import event_ts_of, event_type_of, project

LINE_CAP = 1024 * 1024
OVERSIZE = '{"event_type":"line_too_long"}'
REPLAY_SECONDS = 30


def guarded(lines: DataFrame, cap: int = LINE_CAP) -> DataFrame:
    """A line over the cap is replaced by one marker; its content is not passed on."""
    return lines.withColumn("value", F.when(F.octet_length("value") > cap, OVERSIZE).otherwise(F.col("value")))


def parse_events(lines: DataFrame) -> DataFrame:
    """source, ts, event_type and payload of raw log lines, whatever dialect they are written in."""
    body = F.col("value")
    inner = F.get_json_object(body, "$.payload")
    return guarded(lines).withColumns(
        {"ts": event_ts_of(body), "event_type": event_type_of(body), "payload": F.coalesce(inner, body)}
    ).drop("value")


def log_stream(spark: SparkSession, sources: dict[str, str], files_per_trigger: int = 1000) -> DataFrame:
    """Several log folders as one stream of raw lines tagged with their source."""
    parts = [
        spark.readStream.option("maxFilesPerTrigger", files_per_trigger)
        .text(path)
        .select("value", F.lit(name).alias("source"), case_of(F.col("_metadata.file_path")).alias("case_id"))
        for name, path in sources.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def live_projection(spark: SparkSession, sources: dict[str, str]) -> DataFrame:
    """The projected stream; stateless, so it scales with the input alone."""
    return project(parse_events(log_stream(spark, sources)), keep=["case_id"])


def replay(events: DataFrame, asof: Column, seconds: int = REPLAY_SECONDS, ts: str = "event_ts") -> DataFrame:
    """Events of the last `seconds` before `asof`, compared at second precision."""
    start = F.date_trunc("second", asof) - F.make_dt_interval(secs=F.lit(seconds))
    return events.filter(F.date_trunc("second", F.col(ts)) >= start)


def funnel_updates(decisions: DataFrame) -> DataFrame:
    """Running decision figures per case from a stream of decision rows (update mode)."""
    return decisions.groupBy("case_id").agg(
        F.count(F.lit(1)).alias("decisions"),
        F.count_if(F.col("decision") == "accept_exclude").alias("leak_excluded"),
        F.count_if(~F.coalesce("decision", F.lit("")).isin("", "pending")).alias("decided"),
    )


def append_updates(
    updates: DataFrame, path: str, checkpoint: str, available_now: bool = True, keys: tuple[str, ...] = ("case_id",)
) -> StreamingQuery:
    """Keep the changed groups of a stateful aggregate, batch by batch, in a state table.

    The current state is the row of the highest batch per key. A repeated batch changes nothing.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        state_table.add_run(batch, batch_id, path, list(keys), "batch_id")

    writer = updates.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(write)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def latest_decisions_stream(decisions: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Latest decision per key, kept up as batches arrive: each batch is first reduced to one row per key."""

    def write(batch: DataFrame, batch_id: int) -> None:
        state_table.add_run(batch, batch_id, path, ["case_id", "ref"], "seq")

    return (
        decisions.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(write).start()
    )


def current_state(spark: SparkSession, path: str, keys: list[str], seq: str = "batch_id") -> DataFrame:
    """Newest row per key of a table written by the functions above; few runs are read, however many batches there were."""
    return state_table.read_state(spark, path, keys, seq)
