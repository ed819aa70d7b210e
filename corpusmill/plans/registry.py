"""Query registry: name -> (Spark query, DuckDB oracle SQL or None).

Each Spark query takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the
driver's tables. The oracle is ANSI/DuckDB SQL over the same tables, with the
same column names.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    fn: QueryFn
    sql: str | None
    operator: str  # SURVEY id, e.g. "T17"


REGISTRY: dict[str, Query] = {}


def register(name: str, operator: str, sql: str | Callable[[], str] | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in REGISTRY:
            raise ValueError(f"query {name!r} registered twice")
        text = sql() if callable(sql) else sql
        REGISTRY[name] = Query(name, fn, text, operator)
        return fn

    return deco


def _load_all() -> None:
    # Importing the modules fills REGISTRY.
    from . import (  # noqa: F401
        q_categories,
        q_dedup,
        q_registry,
        q_reshape,
        q_sources,
        q_stats,
        q_streaming,
        q_text,
    )


def queries() -> dict[str, QueryFn]:
    _load_all()
    return {k: v.fn for k, v in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    _load_all()
    return {k: v.sql for k, v in REGISTRY.items() if v.sql is not None}
