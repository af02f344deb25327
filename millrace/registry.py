"""Registry of named queries and the SQL each one is checked against."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    ops: tuple[str, ...]
    run: QueryFn
    oracle: str | None


QUERIES: dict[str, Query] = {}


def query(name: str, ops: str, oracle: str | None = None) -> Callable[[QueryFn], QueryFn]:
    """Register ``fn(spark, sf_dir)`` under ``name`` with its operator IDs."""

    def register(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = Query(name, tuple(ops.split()), fn, oracle)
        return fn

    return register
