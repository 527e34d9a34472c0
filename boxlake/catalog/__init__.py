"""Queries over the test tables, each beside the SQL that must give the same rows."""

from boxlake.catalog import absences, facts, files, games, ids, logs, named, pages, trees  # noqa: F401
from boxlake.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
