"""Every registered query with the SQL that must give the same rows."""

from __future__ import annotations

from . import queries_bands, queries_core, queries_io, queries_months, queries_predictions

MODULES = [queries_core, queries_bands, queries_predictions, queries_io, queries_months]


def queries() -> dict:
    return {name: query for m in MODULES for name, (query, _) in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: text for m in MODULES for name, (_, text) in m.QUERIES.items() if text}
