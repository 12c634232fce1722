"""Operators for training-data pipelines, each bound to the test tables as a query."""

from .queries import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
