"""Queries over the given tables and the SQL each must agree with."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
VIEWS: dict[str, tuple[str, tuple[str, ...]]] = {}


def view(name: str, sql: str, uses: Sequence[str] = ()) -> None:
    """A named SQL view that oracles may use."""
    VIEWS[name] = (sql, tuple(uses))


def with_views(names: Sequence[str], body: str) -> str:
    """``body`` preceded by the views it uses, each after the ones it depends on."""
    order: list[str] = []

    def add(name: str) -> None:
        for needed in VIEWS[name][1]:
            add(needed)
        if name not in order:
            order.append(name)

    for name in names:
        add(name)
    head = ", ".join(f"{n} AS ({VIEWS[n][0]})" for n in order)
    return f"WITH {head} {body}" if head else body


def query(name: str, sql: str | None = None, uses: Sequence[str] = ()) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = with_views(uses, sql)
        return fn

    return add
