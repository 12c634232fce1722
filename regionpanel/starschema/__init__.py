"""The operators bound to the star-schema tables, each with an SQL statement of the same result."""

from . import (  # noqa: F401  (each module registers its queries)
    clean_queries,
    facts_queries,
    panel_queries,
    report_queries,
    rollup_queries,
    source_queries,
    stats_queries,
)
from .registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
