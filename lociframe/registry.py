"""All queries by name, and their SQL."""

from __future__ import annotations

from .plans import ancestry_queries, annotation_queries, file_queries, format_queries, graph_queries, ordered_queries, site_queries  # noqa: F401
from .plans.catalog import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
