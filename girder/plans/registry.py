"""All queries of the engine by name."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

#: Each module holds QUERIES and ORACLE_SQL.
MODULES = ("inspections", "contractors", "outreach", "changes", "scalars", "intake")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
    for name in MODULES:
        found |= import_module(f"girder.plans.{name}").QUERIES
    return found


def oracle_sql() -> dict[str, str]:
    found: dict[str, str] = {}
    for name in MODULES:
        found |= import_module(f"girder.plans.{name}").ORACLE_SQL
    return found
