"""All registered queries."""

from __future__ import annotations

from . import graph_queries, response_queries, scalar_queries, source_queries, stream_queries  # noqa: F401
from .registry import ORACLES, QUERIES, Query


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
