"""Registered queries, each with the SQL that says the same to DuckDB, where SQL can say it."""

from typing import Callable

from pyspark.sql import DataFrame, SparkSession

from shelfmatch.plans.views import VIEWS

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, views: tuple = (), ctes: tuple = ()):
    """Register a query. ``views`` and ``ctes`` are put in front of ``sql`` as common table expressions."""

    def add(function):
        QUERIES[name] = function
        if sql is not None:
            heads = [f"{v} as ({VIEWS[v]})" for v in views] + [f"{n} as ({text})" for n, text in ctes]
            ORACLES[name] = (f"with {', '.join(heads)}\n" if heads else "") + sql.strip()
        return function

    return add
