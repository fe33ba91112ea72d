"""Registry of the catalog queries and of their SQL twins."""

from __future__ import annotations

from shelfmark.oracle_catalog import ORACLE_SQL
from shelfmark.queries_catalog import QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
