"""One query per operator, each with the SQL that says what it must give."""

from __future__ import annotations

from millrace.queries import bookkeeping, changes, flows, quality, scans, shapes, snapshots, writes
from millrace.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "bookkeeping", "changes", "flows", "quality", "scans", "shapes", "snapshots", "writes"]
