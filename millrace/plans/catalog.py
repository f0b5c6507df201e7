"""All registered queries."""

from millrace.plans import claims, classify, ratings, tables, weblog  # noqa: F401
from millrace.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
