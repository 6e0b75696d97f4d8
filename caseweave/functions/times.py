"""Time expressions. The moment of evaluation is always an argument."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import vocab


def parse_iso(text: Column) -> Column:
    """ISO-8601 text, with Z, an offset or neither (then UTC), as a timestamp; bad text is null."""
    shaped = F.rlike(text, F.lit(r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d+)?)?(Z|[+-]\d{2}:?\d{2})?)?$"))
    return F.when(shaped, F.try_to_timestamp(text))


def age_hours(ts: Column, asof: Column) -> Column:
    hours = (F.unix_micros(asof) - F.unix_micros(ts)) / F.lit(3.6e9)
    return F.coalesce(F.greatest(F.lit(0.0), hours), F.lit(0.0))


def pending_stale(ts: Column, asof: Column) -> Column:
    """An unfinished classification past its window; an unreadable time counts as stale."""
    late = F.unix_micros(asof) - F.unix_micros(ts) > F.lit(vocab.PENDING_HOURS * 3_600_000_000)
    return F.coalesce(late, F.lit(True))


def sla_days(received: Column, asof: Column) -> Column:
    """Days left of the statutory period; null when the date received is unreadable."""
    return F.lit(vocab.SLA_DAYS) - F.datediff(asof, received)
