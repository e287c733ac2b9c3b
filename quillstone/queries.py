"""Queries of the operators over the driver's tables, each with equivalent SQL."""

from __future__ import annotations

from quillstone.plans import catalog, columns, facts, filing_views, guidance, landing, series, streams, texts, upkeep  # noqa: F401  (each registers its queries)
from quillstone.registry import QUERIES, SQL, Query


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
