"""Every operator run over the given tables, each beside the SQL that must give the same rows."""

from panelyard.workload import (  # noqa: F401  (importing registers the queries)
    aggregates, calendars, cursors, expressions, fundamentals, gates, identity, jobs, joins, merges, publication, rows,
    scans, settlements, streams, windows,
)
from panelyard.workload.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
