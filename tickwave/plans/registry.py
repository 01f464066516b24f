"""Registered queries (``(spark, sf_dir) -> DataFrame``) and their DuckDB oracles."""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def load_all() -> None:
    """Import every module that registers queries."""
    from tickwave.plans import (  # noqa: F401
        bronze_queries,
        fx_queries,
        gold_queries,
        io_queries,
        planning_queries,
        quality_queries,
    )
