"""Collects queries with their SQL and expands the fixture tables the SQL names."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from fairreach.catalog.fixtures import FIXTURE_SQL, Tables

_QUERIES: dict[str, Callable[[Tables], DataFrame]] = {}
_ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable:
    """Register a query under ``name``; ``sql`` may use the fixture tables as if they existed."""

    def register(fn: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        if name in _QUERIES:
            raise ValueError(f"{name} is registered twice")
        _QUERIES[name] = fn
        if sql is not None:
            _ORACLES[name] = with_fixtures(sql)
        return fn

    return register


def _needed(sql: str, found: list[str]) -> list[str]:
    for name in re.findall(r"\bfx_\w+", sql):
        if name not in found and name in FIXTURE_SQL:
            _needed(FIXTURE_SQL[name], found)
            found.append(name)
    return found


def with_fixtures(sql: str) -> str:
    """Prefix the common table expressions for every fixture the statement refers to."""
    ctes = [f"{n} AS ({FIXTURE_SQL[n].strip()})" for n in _needed(sql, [])]
    if not ctes:
        return sql.strip()
    body = sql.strip()
    if body[:4].upper() == "WITH":
        return f"WITH {', '.join(ctes)}, {body[4:].lstrip()}"
    return f"WITH {', '.join(ctes)} {body}"


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(fn: Callable[[Tables], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, sf_dir: fn(Tables(spark, sf_dir))

    return {name: bind(fn) for name, fn in _QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLES)
