from __future__ import annotations

from collections.abc import Callable
from textwrap import dedent

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name, with the SQL to compare it with."""

    def add(run: Query) -> Query:
        QUERIES[run.__name__] = run
        if oracle is not None:
            ORACLES[run.__name__] = dedent(oracle).strip()
        return run

    return add
