"""Public view of the registered queries for the driver contract."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import catalog  # noqa: F401  (registers the batch queries)
from .catalog import REGISTRY, build


def _callable(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(name, spark, sf_dir)
    run.__name__ = name
    return run


def query_callables() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _callable(name) for name in REGISTRY}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_fn, sql) in REGISTRY.items() if sql}
