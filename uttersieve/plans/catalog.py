"""Registry of the named queries and of their SQL twins."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from uttersieve.session import ship_package

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
TWINS: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    """Register a function ``(spark, folder) -> DataFrame``."""

    def add(fn):
        key = name or fn.__name__

        def run(spark, folder):
            return fn(ship_package(spark), folder)

        run.__name__, run.__doc__ = key, fn.__doc__
        QUERIES[key] = run
        if sql is not None:
            TWINS[key] = sql
        return fn

    return add


def load():
    """Import the modules that register queries."""
    from uttersieve.plans import (  # noqa: F401
        charts,
        export,
        reports,
        scoring,
        selection,
        streams,
    )

    return QUERIES, TWINS
