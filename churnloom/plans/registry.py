"""Named queries: a Spark callable and, where SQL can express it, the same question as SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(function: Callable[[SparkSession, str], DataFrame]):
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return register


def r(expression: str, digits: int) -> str:
    """The SQL form of rounding half to even."""
    return f"(round_even(({expression})*1e{digits},0)/1e{digits})"
