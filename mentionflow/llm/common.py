"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..session import materialize

#: Rows of a few numbers that are broadcast at most; beyond that the same join shuffles.
BROADCAST_ROWS = 2_000_000

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ship_code(module: str) -> None:
    """Lets functions of a module travel to the executors whole, which need no copy of this library."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """Lower-cases A to Z only."""
    return F.translate(text, UPPER, LOWER)


def boxed(df: DataFrame, **keys: Column) -> DataFrame:
    """All columns as one struct ``_row`` beside an operator's own columns.

    Whatever an extra column is called, it cannot clash with those; ``unboxed`` undoes it.
    """
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"),
                     *[value.alias(name) for name, value in keys.items()])


def unboxed(df: DataFrame, columns: list[str], added: dict[str, Column]) -> DataFrame:
    """The columns of ``_row``, then the added ones, which replace others of their name."""
    kept = [F.col("_row").getField(c).alias(c) for c in columns if c not in added]
    return df.select(*kept, *[value.alias(name) for name, value in added.items()])


def pieces(batches: Iterable[pd.DataFrame], rows: int = 1000) -> Iterator[pd.DataFrame]:
    """The rows of Arrow batches, fewer at a time: bounds what a Python worker works on beside its input."""
    for batch in batches:
        for start in range(0, len(batch), rows):
            yield batch.iloc[start:start + rows]


def bounded(rows: DataFrame) -> DataFrame:
    """Marks rows of a few numbers for broadcast, after counting that they are few."""
    return F.broadcast(rows) if rows.count() <= BROADCAST_ROWS else rows


def numbered(df: DataFrame, order: list[Column], name: str = "_number") -> DataFrame:
    """Adds 0, 1, 2, … in the given order without bringing all rows into one task.

    Rows are range-partitioned and written once; each range is numbered on its own and
    shifted by the sizes of the ranges before it (one row per partition).
    """
    ranged = materialize(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "numbered")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = (ranged.groupBy("_part").agg(F.count("*").alias("_size"))
              .select(F.col("_part").alias("_of"), F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_shift")))
    local = F.row_number().over(Window.partitionBy("_part").orderBy(*order)) - 1
    return (ranged.withColumn(name, local).join(F.broadcast(shifts), F.col("_part") == F.col("_of"))
            .withColumn(name, F.col(name) + F.col("_shift")).drop("_part", "_of", "_shift"))


ship_code(__name__)
