"""Every named query, collected from the query modules."""

from lakemill.plans import evaluation_queries, gold_queries, ingest_queries, message_queries, model_queries, quality_queries  # noqa: F401
from lakemill.plans.catalog import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
