"""Numeric expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import vocab


def rate(part: Column, whole: Column) -> Column:
    """part / whole, null when there is nothing to divide by."""
    return F.when(whole > 0, part / whole)


def wilson(hits: Column, total: Column, z: float = vocab.WILSON_Z) -> tuple[Column, Column]:
    """Lower and upper Wilson score bound, null when total is zero."""
    n = F.when(total > 0, total.cast("double"))
    p = hits / n
    centre = p + z * z / (2 * n)
    spread = z * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n))
    scale = 1 + z * z / n
    lower = F.when(n.isNotNull(), F.greatest(F.lit(0.0), (centre - spread) / scale))
    upper = F.when(n.isNotNull(), F.least(F.lit(1.0), (centre + spread) / scale))
    return lower, upper


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, v: s + v)


def norm(v: Column) -> Column:
    """Length of a vector, never zero."""
    size = F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    return F.when(size == 0, F.lit(1e-12)).otherwise(size)


def cosine(a: Column, b: Column) -> Column:
    return _dot(a, b) / (norm(a) * norm(b))


def clamp01(x: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), x))


def lookup(mapping: dict, key: Column, default: Column | None = None) -> Column:
    """Value of a small fixed table by key."""
    table = F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])
    hit = F.try_element_at(table, key)
    return hit if default is None else F.coalesce(hit, default)


def zero_filled(domain: list[str], column: Column, prefix: str = "n_") -> list[Column]:
    """One count per value of a closed vocabulary, zero where absent."""
    return [F.count_if(column == v).alias(f"{prefix}{v}") for v in domain]
