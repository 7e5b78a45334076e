"""The ``opN_<name>`` queries of this subpackage and their DuckDB oracles."""

from __future__ import annotations

from caseloom.llm import bpe, chat, exact_dedup, licenses, line_dedup, minhash, packing, quality, sharding, urls

_MODULES = (chat, exact_dedup, bpe, sharding, line_dedup, minhash, packing, quality, licenses, urls)


def queries() -> dict:
    """Query name -> callable(spark, sf_dir) -> DataFrame."""
    return {name: query for module in _MODULES for name, query in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    """Query name -> DuckDB SQL over the same tables."""
    return {name: sql for module in _MODULES for name, sql in module.ORACLE_SQL.items()}
