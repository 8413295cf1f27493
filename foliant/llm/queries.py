"""The subpackage's registered queries and their DuckDB texts."""

from __future__ import annotations

from . import bpe, exact_dedup, licenses, mixing, quality_model, quality_rules, secrets, simhash, toxicity, url_filter

_MODULES = [mixing, url_filter, exact_dedup, bpe, quality_rules, secrets, quality_model, simhash, licenses, toxicity]


def queries() -> dict:
    return {name: f for module in _MODULES for name, f in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for module in _MODULES for name, sql in module.ORACLES.items()}
