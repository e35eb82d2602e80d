"""Registry of queries by stable id, each with its SQL twin where one exists."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerlake.plans.adapter import Lake, sql

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    """Register a function of a :class:`Lake`; ``oracle`` may use the adapter's SQL views."""
    def wrap(build: Callable[[Lake], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, folder: build(Lake(spark, folder))
        if oracle is not None:
            ORACLES[name] = sql(oracle)
        return build
    return wrap


def load() -> None:
    """Import every module that registers queries."""
    from ledgerlake.plans import analytics, checks, dashboards, histories, scalars, storage, streams  # noqa: F401
