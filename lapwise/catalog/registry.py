"""Where queries and their check SQL are put together."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


def query(name: str, check: str | None = None) -> Callable[[Query], Query]:
    """Register a query; without `check` only its rows are verified."""

    def register(run: Query) -> Query:
        QUERIES[name] = run
        if check is not None:
            CHECKS[name] = check
        return run

    return register
