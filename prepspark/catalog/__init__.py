"""Registry of named queries and their DuckDB oracle SQL.

Each query is a callable ``(spark, sf_dir) -> DataFrame`` that reads the
test tables (or a view derived from them by SQL) and runs one operator over
the whole input.  ``oracle`` holds, where the operator is SQL-expressible,
an equivalent DuckDB query over the same tables with identical column names.
"""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn`` under ``name`` with an optional oracle SQL string."""

    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return deco


def _load_all() -> None:
    from . import q_profile, q_quality, q_clean, q_transform, q_select, q_registry  # noqa: F401


def queries() -> dict[str, Callable]:
    _load_all()
    return dict(QUERIES)


def oracles() -> dict[str, str]:
    _load_all()
    return dict(ORACLES)
