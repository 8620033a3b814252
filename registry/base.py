"""Registration of queries and of the SQL that must give the same rows."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from rastergrid.session import ship_package

from .derived import Derived, derived_sql

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, tables: tuple[str, ...] = ()):
    """Register ``fn(derived) -> DataFrame``; ``tables`` are derived tables the SQL uses."""

    def add(fn: Callable[[Derived], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            ship_package(spark, os.path.dirname(__file__))
            return fn(Derived(spark, sf_dir))

        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = derived_sql(tables, sql)
        return fn

    return add
