"""All core queries by name."""

from __future__ import annotations

from . import admission_queries, build_queries, core_problems, place_queries, report_queries, signal_queries, surface_queries

_MODULES = (core_problems, signal_queries, admission_queries, place_queries, report_queries, build_queries, surface_queries)

FLAGSHIP = signal_queries.q01_attention_signal


def queries() -> dict:
    return {k: v for m in _MODULES for k, v in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: v for m in _MODULES for k, v in m.SQL.items()}
