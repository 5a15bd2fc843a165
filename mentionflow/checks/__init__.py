"""Every operator as a query over the given tables, with the SQL that must agree."""

from __future__ import annotations

from . import registry
from . import batch, events, layers, payloads, reports, scalars, streams, tables  # noqa: F401


def queries():
    return {name: run for name, (run, _) in registry.CHECKS.items()}


def oracle_sql():
    return {name: sql for name, (_, sql) in registry.CHECKS.items() if sql}
