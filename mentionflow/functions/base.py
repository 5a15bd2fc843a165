"""Small helpers for expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def bind(value: Column, body) -> Column:
    """``body(value)`` with the value computed once per row, also for use inside lambdas."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def quoted(text: str) -> str:
    """A SQL string literal; the dollar sign is coded, as ``${`` would be substituted."""
    plain = text.replace("\\", "\\\\").replace("'", "\\'").replace("$", "\\u0024")
    return f"'{plain}'"


def strings(values) -> Column:
    """Array literal. One SQL text, as thousands of single literals take seconds to build."""
    return F.expr(f"CAST(array({', '.join(map(quoted, values))}) AS array<string>)")


def keep_in(array: Column, values: list[str]) -> Column:
    """Elements that are among the values: a hash-set probe per element."""
    if not values:
        return F.filter(array, lambda x: F.lit(False))
    return F.call_function("filter", array, F.expr(f"x -> x IN ({', '.join(map(quoted, values))})"))


def explode_if(value: Column, condition) -> Column:
    """Generator that keeps a row when ``condition(value)`` holds and drops it otherwise.

    A filter on a computed column is pushed below the column and computes it twice; a
    generator computes it once.
    """
    return F.explode(F.filter(F.array(value), condition))
