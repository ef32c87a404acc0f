"""Imports every query module so that the registry is complete, then re-exports it."""

from __future__ import annotations

from stockroom.plans import (  # noqa: F401
    decision_queries,
    journal_queries,
    lake_queries,
    ledger_queries,
    po_queries,
    publish_queries,
    stream_queries,
    warehouse_queries,
)
from stockroom.plans.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
