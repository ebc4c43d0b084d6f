"""All queries by name, and the SQL of those that SQL can express."""

from __future__ import annotations

from ledgerbrook.catalog import batch, oracles, streams
from ledgerbrook.catalog.batch import Query


def queries() -> dict[str, Query]:
    return {**batch.QUERIES, **streams.QUERIES}


def oracle_sql() -> dict[str, str]:
    return dict(oracles.SQL)
