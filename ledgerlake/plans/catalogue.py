"""The register of queries: each by its name, with its SQL if it has any."""

from __future__ import annotations

from collections.abc import Callable

from ledgerlake.session import Query

QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add
