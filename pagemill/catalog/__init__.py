"""All registered queries."""

from pagemill.catalog import compare, context, display, entities, gates, native, pointers, rendered, runs, story  # noqa: F401
from pagemill.catalog.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
