"""Registry of named queries: a Spark builder and, where one exists, the
equivalent DuckDB SQL over the same parquet tables.

A builder takes ``(spark, sf_dir)`` and returns a ``DataFrame`` that the caller
runs. What it reads beside the given tables (stored telemetry, CSV copies, the
staged feed) is written on first use, and streams are drained in the builder;
the rest is lazy. Output column names are identical on both sides.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    build: Builder
    sql: str | None
    note: str = ""


REGISTRY: dict[str, Query] = {}


def register(name: str, sql: str | None = None, note: str = ""):
    def wrap(fn: Builder) -> Builder:
        if name in REGISTRY:
            raise ValueError(f"query {name!r} registered twice")
        REGISTRY[name] = Query(name, fn, sql, note)
        return fn
    return wrap


def _load_all() -> None:
    # Importing the modules fills REGISTRY.
    from tramline.plans import batch_queries, scan_queries, stored_queries  # noqa: F401
    from tramline.streaming import stream_queries  # noqa: F401


def queries() -> dict[str, Builder]:
    _load_all()
    return {name: q.build for name, q in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    _load_all()
    return {name: q.sql for name, q in REGISTRY.items() if q.sql}
