"""The registered queries of the core engine and their DuckDB oracles."""

from __future__ import annotations

from caseloom.plans import annotation_plans, audit_plans, base, graph_plans, semantic_plans, source_plans, stream_plans, text_plans  # noqa: F401


def queries() -> dict:
    return dict(base.QUERIES)


def oracle_sql() -> dict:
    return dict(base.ORACLE_SQL)
