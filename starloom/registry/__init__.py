"""The warehouse build on the benchmark tables, and the SQL that states its results."""

from . import column_queries, extract_queries, join_queries, load_queries  # noqa: F401  (they register queries)
from .catalog import oracle_sql, queries

__all__ = ["oracle_sql", "queries"]
