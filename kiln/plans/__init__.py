"""Catalogue of registered queries over the driver tables.

Each query is ``fn(spark, sf_dir) -> DataFrame``; most carry an equivalent
DuckDB SQL string (the oracle). Query modules register themselves with
``@query(name, sql)`` on import.
"""

from __future__ import annotations

from collections.abc import Callable

REGISTRY: dict[str, tuple[Callable, str | None]] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


def _load_modules() -> None:
    from kiln.plans import (  # noqa: F401
        text_queries,
        vocab_queries,
        ev_queries,
        series_queries,
        weather_queries,
        vector_queries,
        ml_queries,
        experiment_queries,
        source_queries,
    )


def queries() -> dict[str, Callable]:
    _load_modules()
    return {k: v[0] for k, v in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    _load_modules()
    return {k: v[1] for k, v in REGISTRY.items() if v[1]}
