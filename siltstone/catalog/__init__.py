"""Registered queries over the test tables, and their SQL counterparts."""

from siltstone.catalog.oracle import oracle_sql
from siltstone.catalog.queries import queries

__all__ = ["oracle_sql", "queries"]
