"""Registry of named queries (Spark builders) and their DuckDB oracle SQL."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}

_MODULES = [
    "riskframe.plans.q_policy",
    "riskframe.plans.q_prep",
    "riskframe.plans.q_woe",
    "riskframe.plans.q_metrics",
    "riskframe.plans.q_loss",
    "riskframe.plans.q_drift",
    "riskframe.plans.q_selection",
    "riskframe.plans.q_models",
    "riskframe.plans.q_reports",
    "riskframe.plans.q_stream",
    "riskframe.plans.q_artifacts",
]


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def load_all() -> None:
    for m in _MODULES:
        importlib.import_module(m)
