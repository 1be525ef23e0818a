"""Registry of named queries: a Spark builder plus its DuckDB oracle SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass
class Registered:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    operators: str


REGISTRY: dict[str, Registered] = {}


def query(name: str, operators: str = "", sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name``."""
    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Registered(name, fn, sql.strip() if sql else None, operators)
        return fn
    return deco


def load_all() -> dict[str, Registered]:
    # Import for side effects: each module registers its queries.
    from ledgerline.plans import (q_incremental, q_dedupe, q_joins, q_text,  # noqa: F401
                                  q_dates, q_lifecycle, q_columns, q_jobs, q_loaders, q_org,
                                  q_storage)
    return REGISTRY
