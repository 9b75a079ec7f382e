"""Registry of the core's queries and of their DuckDB counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

FLAGSHIP = "e05_expand"
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    """Register a query function under ``name``, with its DuckDB SQL where there is one."""

    def add(f):
        QUERIES[name] = f
        if oracle is not None:
            ORACLES[name] = oracle
        return f

    return add

from paperloom.plans import entry_queries, state_queries, text_queries  # noqa: E402,F401  (they register themselves)
