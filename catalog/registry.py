"""All catalogue queries and their check SQL."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

from catalog.inputs import inputs

MODULES = ["q_features", "q_labels", "q_eda", "q_monitor", "q_columns", "q_ingest", "q_models"]


def _modules():
    for name in MODULES:
        yield import_module(f"catalog.{name}")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bound(fn):
        return lambda spark, sf_dir: fn(inputs(spark, sf_dir))

    return {name: bound(fn) for m in _modules() for name, fn in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: text for m in _modules() for name, text in m.ORACLE.items()}
