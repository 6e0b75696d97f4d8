"""Progress of a long batch: rows seen, rate and time left, from Spark's own observations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def observed(df: DataFrame, name: str = "progress", error: Column | None = None) -> tuple[DataFrame, Observation]:
    """The same rows, counted as they pass; read `observation.get` after the action."""
    watch = Observation(name)
    bad = F.count_if(error.isNotNull()) if error is not None else F.lit(0).cast("bigint")
    return df.observe(watch, F.count(F.lit(1)).alias("processed"), bad.alias("errors")), watch


def eta(processed: int, total: int, elapsed_s: float) -> dict[str, float | None]:
    """Rate per second and seconds left; unknown until something was processed."""
    rate = processed / elapsed_s if elapsed_s > 0 else 0.0
    return {"rate_per_s": rate, "eta_s": (total - processed) / rate if rate > 0 else None}
