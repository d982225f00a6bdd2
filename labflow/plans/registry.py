"""Every query of the library by name, and its SQL twin."""

from __future__ import annotations

from . import aggregate_queries, inference_queries, job_queries, rowwise_queries
from .aggregate_queries import flagship

QUERIES = rowwise_queries.QUERIES | job_queries.QUERIES | aggregate_queries.QUERIES | inference_queries.QUERIES
SQL = rowwise_queries.SQL | job_queries.SQL | aggregate_queries.SQL | inference_queries.SQL

__all__ = ["QUERIES", "SQL", "flagship"]
