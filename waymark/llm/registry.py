"""All queries of the subpackage by name."""

from __future__ import annotations

from . import queries_records, queries_texts

_MODULES = (queries_records, queries_texts)


def queries() -> dict:
    return {k: v for m in _MODULES for k, v in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: v for m in _MODULES for k, v in m.SQL.items()}
