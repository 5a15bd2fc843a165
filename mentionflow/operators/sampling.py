"""Samples that a rerun, another cluster or another engine draws again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

_DIGITS = 12


def draw(keys: list[str], seed: int = 0) -> Column:
    """A number in [0, 1) that depends on the keys and the seed only."""
    parts = [F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]
    digits = F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), *parts)), 1, _DIGITS)
    return F.conv(digits, 16, 10).cast("double") / float(16 ** _DIGITS)


def sample_rows(df: DataFrame, fraction: float, keys: list[str], seed: int = 0) -> DataFrame:
    """Bernoulli sample by key: every key is in or out whatever rows surround it."""
    return df.where(draw(keys, seed) < fraction)


def spread(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Rows dealt evenly over tasks."""
    return df.hint("rebalance") if partitions is None else df.repartition(partitions)
