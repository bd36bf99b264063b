"""All registered queries of the library's own operators, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its own name, with the SQL that gives the same rows."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


from terraledger.plans import accounts, checks, fits, geometry, graphs, gridded, lines, networks, physics, regions, relational, rules, summaries, tallies, ways  # noqa: E402, F401
