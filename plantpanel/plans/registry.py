"""Queries over the driver's tables and their SQL counterparts."""

from __future__ import annotations

from . import analysis_queries, panel_queries, row_queries, series_queries, source_queries  # noqa: F401
from .base import QUERIES, SQL, Query


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
