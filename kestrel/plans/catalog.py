"""Registered queries: each Spark callable paired with its DuckDB oracle SQL.

A query reads the driver tables (through the derived views in
``kestrel.sources.tables``) and returns a DataFrame whose columns are
aliased and rounded exactly like the oracle text.  Modules in
``kestrel.plans`` register themselves here on import.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def load_all() -> None:
    """Import every ``kestrel.plans.q_*`` module (registration side effect)."""
    import importlib
    import pkgutil

    import kestrel.plans as pkg
    for m in sorted(pkgutil.iter_modules(pkg.__path__), key=lambda m: m.name):
        if m.name.startswith("q_"):
            importlib.import_module(f"kestrel.plans.{m.name}")
