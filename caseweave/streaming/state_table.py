"""The current state of a stream as a table of merged runs.

Each batch writes its newest row per key as a run of level 0. As soon as there are FANOUT runs of a level they are merged
into one of the next, so after n batches there are at most (FANOUT - 1) * log n runs to read. A run counts from the
moment Spark has committed it, and hides the runs it was made of; those are deleted one merge later, when no
reader that began before still needs them. Writing a batch again changes nothing.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.latest import latest_per_key

FANOUT = 4
_NAME = re.compile(r"level=(\d+)-(\d+)-(\d+)$")
Run = tuple[int, int, int]  # level, first and last batch


def _files(spark: SparkSession, path: str):
    """The file system of the path, as Spark sees it, and a maker of its paths."""
    made = spark._jvm.org.apache.hadoop.fs.Path
    return made(path).getFileSystem(spark._jsc.hadoopConfiguration()), made


def _name(path: str, run: Run) -> str:
    return f"{path}/level={run[0]}-{run[1]}-{run[2]}"


def committed(spark: SparkSession, path: str) -> list[Run]:
    """All runs that are whole."""
    files, made = _files(spark, path)
    if not files.exists(made(path)):
        return []
    found = [_NAME.search(str(s.getPath())) for s in files.listStatus(made(path))]
    runs = [(int(m[1]), int(m[2]), int(m[3])) for m in found if m]
    return sorted(r for r in runs if files.exists(made(f"{_name(path, r)}/_SUCCESS")))


def live(spark: SparkSession, path: str) -> list[Run]:
    """Runs that no run of a higher level has taken in."""
    runs = committed(spark, path)
    return [r for r in runs if not any(o[0] > r[0] and o[1] <= r[1] and r[2] <= o[2] for o in runs)]


def add_run(batch: DataFrame, batch_id: int, path: str, keys: list[str], seq: str) -> None:
    """Take a batch in: its newest row per key becomes a run, and full levels are merged."""
    spark = batch.sparkSession
    if any(first <= batch_id <= last for _, first, last in committed(spark, path)):
        return
    _write(batch.withColumn("batch_id", F.lit(batch_id).cast("bigint")), path, (0, batch_id, batch_id), keys, seq)
    level = 0
    while len(full := [r for r in live(spark, path) if r[0] == level]) >= FANOUT:
        merged = (level + 1, full[0][1], full[-1][2])
        _write(_read(spark, path, full), path, merged, keys, seq)
        _forget(spark, path, full)
        level += 1


def _write(rows: DataFrame, path: str, run: Run, keys: list[str], seq: str) -> None:
    latest_per_key(rows, keys, seq).drop("n_rows").write.mode("overwrite").parquet(_name(path, run))


def _read(spark: SparkSession, path: str, runs: list[Run]) -> DataFrame:
    return spark.read.parquet(*(_name(path, r) for r in runs))


def _forget(spark: SparkSession, path: str, fresh: list[Run]) -> None:
    """Delete hidden runs, but for those that have just been merged."""
    files, made = _files(spark, path)
    keep = {*live(spark, path), *fresh}
    for run in committed(spark, path):
        if run not in keep:
            files.delete(made(_name(path, run)), True)


def read_state(spark: SparkSession, path: str, keys: list[str], seq: str = "batch_id") -> DataFrame:
    """Newest row per key over all batches taken in."""
    return latest_per_key(_read(spark, path, live(spark, path)), keys, seq).drop("n_rows")
