"""Registered queries, each next to its check SQL."""

from __future__ import annotations

from . import markup, records, runs, scalars, tables, web
from .base import Query

MODULES = [scalars, web, tables, markup, records, runs]


def queries() -> dict[str, Query]:
    return {name: query for module in MODULES for name, query in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for module in MODULES for name, sql in module.ORACLES.items()}
