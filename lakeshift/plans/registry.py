"""All registered queries and oracle SQL (importing the modules registers them)."""

from lakeshift.plans import io_queries as _io  # noqa: F401  (registers on import)
from lakeshift.plans.queries import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
