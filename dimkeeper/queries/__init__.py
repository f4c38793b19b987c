"""Queries on the test tables, each with the SQL that states its result independently."""

from dimkeeper.queries import histories, merges, previous, tables, versions
from dimkeeper.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "histories", "merges", "previous", "tables", "versions"]
