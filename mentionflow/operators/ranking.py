"""Ranks and numbering that never put a whole frame, or a hot group, in one task.

Numbers are split into value ranges that follow their order. Each range is ranked on its
own, then shifted by what the ranges before it hold. A range is the number's bit length
plus its eight leading bits and its sign, so there are at most 32,768 of them per group and the table
of shifts stays small whatever the data size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

_RANGE = "_range"


def value_range(number: Column) -> Column:
    """Range of a whole number; larger numbers never get a smaller range.

    The range of a negative number is the mirror image of its complement's.
    """
    number = number.cast("long")
    size = F.when(number < 0, F.bitwise_not(number)).otherwise(number)
    bits = F.length(F.bin(size))
    lead = F.call_function("shiftright", size, F.greatest(bits - 9, F.lit(0)))
    place = bits * 256 + F.pmod(lead, F.lit(256))
    return F.when(number < 0, -1 - place).otherwise(place).cast("int")


def _join_null_safe(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join on keys that may be NULL; the keys of the left side stay."""
    renamed = right.select(*[F.col(k).alias(f"_r_{k}") if k in keys else F.col(k) for k in right.columns])
    on = F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_r_{k}"))
    return left.join(renamed, on).drop(*[f"_r_{k}" for k in keys])


def _number_within(rows: DataFrame, order: str, group: list[str], name: str, descending: bool) -> DataFrame:
    """1, 2, 3, … per group over rows that carry their range."""
    def way(c: str) -> Column:
        return F.col(c).desc() if descending else F.col(c).asc()

    before = (Window.partitionBy(*group).orderBy(way(_RANGE))
              .rowsBetween(Window.unboundedPreceding, -1))
    shifts = (rows.groupBy(*group, _RANGE).agg(F.count("*").alias("_size"))
              .select(*group, _RANGE, F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_shift")))
    inner = Window.partitionBy(*group, _RANGE).orderBy(way(order))
    numbered = rows.withColumn(name, F.row_number().over(inner))
    return (_join_null_safe(numbered, shifts, [*group, _RANGE])
            .withColumn(name, F.col(name) + F.col("_shift")).drop("_shift", _RANGE))


def add_dense_ranks(df: DataFrame, value: str, ranks: dict[str, list[str]]) -> DataFrame:
    """Adds dense ranks of ``value``, descending, one per entry {rank column: group columns}.

    The distinct values are ranked and joined back. They hold each value once, so a value
    or group with most of the rows only meets the join, which AQE may split there.
    """
    out = df
    for name, group in ranks.items():
        values = df.select(*group, value).distinct().withColumn(_RANGE, value_range(F.col(value)))
        ranked = _number_within(values, value, group, name, descending=True)
        out = _join_null_safe(out, ranked.withColumn(name, F.col(name).cast("int")), [*group, value])
    return out


def add_row_numbers(df: DataFrame, order: str, group: list[str], name: str = "row_number") -> DataFrame:
    """Adds 1, 2, 3, … per group in the order of a whole number that is unique in its group.

    Ranges are taken above the group's smallest number, so numbers that all start far
    from zero still spread over many ranges.
    """
    lowest = df.groupBy(*group).agg(F.min(order).alias("_lowest"))
    rows = (_join_null_safe(df, lowest, group)
            .withColumn(_RANGE, value_range(F.col(order) - F.col("_lowest"))).drop("_lowest"))
    return _number_within(rows, order, group, name, descending=False)


def top_n(df: DataFrame, order: list, n: int) -> DataFrame:
    """First ``n`` rows; every task keeps only its own ``n`` candidates."""
    return df.orderBy(*order).limit(n)


def top_per_group(df: DataFrame, rank: str, n: int) -> DataFrame:
    """Rows up to rank ``n`` of their group, from an existing rank column."""
    return df.where(F.col(rank) <= n)
