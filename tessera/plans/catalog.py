"""Registry of named queries: Spark builder + equivalent DuckDB SQL.

Each entry is ``name -> (builder(spark, sf_dir) -> DataFrame, sql | None)``.
Modules add entries with :func:`register`; ``__spark_entry__`` exposes them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[Builder, str | None]] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Builder) -> Builder:
        if name in REGISTRY:
            raise ValueError(f"duplicate query name {name}")
        REGISTRY[name] = (fn, sql)
        return fn

    return deco


def load_all() -> dict[str, tuple[Builder, str | None]]:
    # importing the modules registers their queries
    from tessera.plans import q_calendar, q_expect, q_features, q_helpers, q_normalize, q_ordered, q_profile, q_sources  # noqa: F401

    return REGISTRY
