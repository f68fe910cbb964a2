"""The registered queries: every operator run over the given tables, with its SQL counterpart."""

from fairreach.catalog import aggregates, batch, cleaning, files, geometry, joins, served, shaping  # noqa: F401
from fairreach.catalog.registry import oracle_sql, queries

__all__ = ["oracle_sql", "queries"]
