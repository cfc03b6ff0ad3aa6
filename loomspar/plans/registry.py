"""Queries over the driver's tables, and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from loomspar.plans import batches, bindings, entities, lookups, rules, scalars, texts

_MODULES = (rules, scalars, lookups, batches, texts, bindings, entities)
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {k: v for m in _MODULES for k, v in m.QUERIES.items()}
SQL: dict[str, str] = {k: v for m in _MODULES for k, v in m.SQL.items()}
