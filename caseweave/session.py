"""Session helpers for tests and the benchmark, and the shared checkpoint folder."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str | int = 8, app: str = "caseweave") -> SparkSession:
    """A small local session. On a cluster the caller brings its own session."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named in spark.checkpoint.dir.

    Where the session names none, a run on one machine (tests, the benchmark) gets a temporary folder, which is
    remembered in the session and deleted when Python ends. On a cluster that is an error: a local folder of the
    driver would be another folder on each executor.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not re.fullmatch(r"local(\[[^,\]]*(,[^\]]*)?\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="caseweave-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def run_folder(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared folder for one run.

    Results may be read for as long as the session lasts, so folders stay until then; a cluster's shared folder
    is cleaned by whoever owns it (their names hold the operation and a random id).
    """
    return os.path.join(shared_folder(spark), f"{name}-{uuid.uuid4().hex}")


def cut_lineage(df: DataFrame) -> DataFrame:
    """The same rows read back from a table in the shared folder.

    Computed once, safe against the loss of executors, and later joins know its size.
    """
    path = run_folder(df.sparkSession, "cut")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
