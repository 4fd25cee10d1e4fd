"""The library's queries and their SQL."""

from . import annotation_queries, job_queries, junction_queries, more_queries  # register their queries
from .queries import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES", "annotation_queries", "job_queries", "junction_queries", "more_queries"]
