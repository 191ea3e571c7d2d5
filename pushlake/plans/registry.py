"""Registry of checked queries: one Spark builder and (where SQL can express it)
one DuckDB oracle per operator id."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    name: str
    build: Builder
    sql: str | None


_REGISTRY: dict[str, Entry] = {}


def register(name: str, sql: str | None = None):
    """Decorator: register ``fn(spark, sf_dir) -> DataFrame`` under ``name``."""

    def deco(fn: Builder) -> Builder:
        if name in _REGISTRY:
            raise ValueError(f"duplicate query {name}")
        _REGISTRY[name] = Entry(name, fn, sql.strip() if sql else None)
        return fn

    return deco


def entries() -> dict[str, Entry]:
    # importing the catalogue modules fills the registry
    from pushlake.plans import catalog  # noqa: F401

    return dict(_REGISTRY)
