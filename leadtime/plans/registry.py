"""Registry binding library operators to the supplied test tables.

Each entry is a callable ``(spark, sf_dir) -> DataFrame`` plus, where the
result can be stated in SQL, the DuckDB text computing the same rows.
Doubles are rounded to 6 digits on both sides; every computed column is
aliased identically.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn
    return deco


def load_all() -> None:
    """Import every module that registers queries."""
    import importlib
    import pkgutil

    import leadtime.plans as pkg
    for m in sorted(pkgutil.iter_modules(pkg.__path__), key=lambda m: m.name):
        if m.name.startswith("bind_"):
            importlib.import_module(f"leadtime.plans.{m.name}")
