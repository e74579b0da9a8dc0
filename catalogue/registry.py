"""All queries by name."""

from __future__ import annotations

from catalogue import binning_queries, lake_queries, ledger_queries, measurement_queries, scoring_queries

MODULES = (lake_queries, binning_queries, scoring_queries, measurement_queries, ledger_queries)


def queries() -> dict:
    return {name: f for m in MODULES for name, f in m.QUERIES.items()}


def oracles() -> dict[str, str]:
    return {name: sql for m in MODULES for name, sql in m.ORACLES.items()}
