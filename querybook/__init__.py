"""Every operator as a named query over the given tables."""

from querybook import changes, dictionary, documents, loads, scans  # noqa: F401  (they register their queries)
from querybook.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
