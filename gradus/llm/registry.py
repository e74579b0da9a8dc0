"""All queries of the text operators by name."""

from __future__ import annotations

from gradus.llm import native_queries, text_queries, vector_queries

MODULES = (native_queries, text_queries, vector_queries)


def queries() -> dict:
    return {name: f for m in MODULES for name, f in m.QUERIES.items()}


def oracles() -> dict[str, str]:
    return {name: sql for m in MODULES for name, sql in m.ORACLES.items()}
