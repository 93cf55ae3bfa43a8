"""Where queries and their check SQL are kept together."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from checks.views import Views, compose

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def check(name: str, sql: str | None = None):
    """Register a query over the views, with the SQL that gives the same rows."""
    def register(build: Callable[[Views], DataFrame]):
        assert name not in QUERIES, name
        QUERIES[name] = lambda spark, sf_dir: build(Views(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = compose(sql)
        return build

    return register
