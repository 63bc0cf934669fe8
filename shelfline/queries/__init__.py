"""Registered queries and the SQL that each must agree with."""

from __future__ import annotations

from shelfline.queries import analytics, cleaning, extraction, ingest, reports, scans  # noqa: F401
from shelfline.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
