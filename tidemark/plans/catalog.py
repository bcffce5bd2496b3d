"""All registered queries."""

from tidemark.plans import change_queries, job_queries, metric_queries, record_queries, scan_queries, sink_queries  # noqa: F401
from tidemark.plans.registry import QUERIES

__all__ = ["QUERIES"]
