"""Registry of named queries and their independent SQL oracles.

Each registered query is ``fn(spark, sf_dir) -> DataFrame`` over the driver
tables (or panels Spark derives from them). The oracle, when given, is
DuckDB SQL over the same tables that computes the same result by a separate
route (usually long-form SQL instead of Spark array/window expressions).
"""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | Callable[[], str] | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql() if callable(sql) else sql
        return fn

    return deco


def sql_r6(expr: str, name: str) -> str:
    """SQL twin of ``functions.common.r6`` (same IEEE operations)."""
    x = f"CAST(({expr}) AS DOUBLE)"
    step = f"power(10.0, floor(log10(abs({x}))) - 11.0)"
    return (f"(CASE WHEN isnan({x}) OR isinf({x}) THEN {x} "
            f"WHEN abs({x}) < 1e6 THEN floor({x} * 1e6 + 0.5) / 1e6 "
            f"ELSE floor({x} / {step} + 0.5) * {step} END) + 0.0 AS {name}")
