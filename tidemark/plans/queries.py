"""The registered queries over the given tables, and their oracles."""

from __future__ import annotations

from tidemark.plans import flows, market, repairs, series, upkeep  # noqa: F401  they register themselves
from tidemark.plans.base import QUERIES, SQL, Query


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
