"""Registered queries."""

from __future__ import annotations

import importlib

from tillstone.queries.registry import CHECKS, QUERIES, Query

MODULES = ("silver_queries", "quality_queries", "log_queries", "manifest_queries", "file_queries", "column_queries", "history_queries", "stream_queries")


def load_all() -> tuple[dict[str, Query], dict[str, str]]:
    """All queries and their check SQL."""
    for module in MODULES:
        importlib.import_module(f"tillstone.queries.{module}")
    return QUERIES, CHECKS
