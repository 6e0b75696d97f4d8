"""All registered queries and their SQL."""

from __future__ import annotations

from . import entity_queries, integrity_queries, people_queries, scope_queries, source_queries  # noqa: F401
from .registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
