"""Registered queries: name -> (Spark callable, SQL twin or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
CHECKS: dict[str, tuple[Query, str | None]] = {}


def check(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        if name in CHECKS:
            raise ValueError(f"query {name} is registered twice")
        CHECKS[name] = (fn, sql)
        return fn

    return add
