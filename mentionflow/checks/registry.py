"""Registration of checked queries."""

from __future__ import annotations

from collections.abc import Callable

CHECKS: dict[str, tuple[Callable, str | None]] = {}


def check(name: str, sql: str | None = None):
    """Register ``run(spark, sf_dir) -> DataFrame`` under a name with its SQL twin."""
    def add(run: Callable) -> Callable:
        if name in CHECKS:
            raise ValueError(f"duplicate query {name}")
        CHECKS[name] = (run, sql)
        return run

    return add
