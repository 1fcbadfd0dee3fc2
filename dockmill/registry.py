"""The registry of queries and their SQL oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from dockmill import fixtures
from dockmill.fixtures import Views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None):
    """Register a function of :class:`Views` under its name, with its oracle."""

    def add(f):
        QUERIES[f.__name__] = lambda spark, sf_dir: f(Views(spark, sf_dir))
        if oracle:
            ORACLES[f.__name__] = fixtures.sql(oracle)
        return f

    return add
