"""Dates: what exists, what is missing, what is complete."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def dates_of(df: DataFrame, column: str = "date") -> DataFrame:
    """Distinct non-null dates as one string column ``date``."""
    return df.where(F.col(column).isNotNull()).select(F.col(column).cast("string").alias("date")).distinct()


def missing_dates(source: DataFrame, target: DataFrame) -> DataFrame:
    """Dates of the source that the target lacks."""
    return dates_of(source).join(dates_of(target), "date", "left_anti")


def all_dates(left: DataFrame, right: DataFrame) -> DataFrame:
    return dates_of(left).union(dates_of(right)).distinct()


def common_dates(left: DataFrame, right: DataFrame) -> DataFrame:
    return dates_of(left).intersect(dates_of(right))


def records_per_date(df: DataFrame) -> DataFrame:
    return df.groupBy("date").agg(F.count("*").alias("records"))


def valid_dates(df: DataFrame, minimum: int = 5, strict: bool = False) -> DataFrame:
    """Dates with enough records: at least ``minimum``, or more than it when ``strict``."""
    enough = F.col("records") > minimum if strict else F.col("records") >= minimum
    return records_per_date(df).where(enough)


def calendar(df: DataFrame, start: Column, end: Column) -> DataFrame:
    """Every day from start to end (inclusive), built from a one-row frame of the bounds."""
    days = F.sequence(start.cast("date"), end.cast("date"), F.expr("interval 1 day"))
    return df.select(F.explode(days).alias("day")).select(F.date_format("day", "yyyy-MM-dd").alias("date"))


def unprocessed_dates(df: DataFrame, start: str | Column, end: str | Column,
                      skip: tuple[str, str] | None = None, minimum: int = 5) -> DataFrame:
    """Days in [start, end] without a complete set of records, outside the skip range.

    The next one to process is the minimum.
    """
    spark = df.sparkSession
    start, end = (F.lit(x) if isinstance(x, str) else x for x in (start, end))
    days = calendar(spark.range(1), start, end)
    if skip:
        days = days.where(~F.col("date").between(*skip))
    return days.join(valid_dates(df, minimum, strict=True), "date", "left_anti")


def hour_coverage(df: DataFrame, max_missing: int = 12) -> DataFrame:
    """Hours present and missing per date, and whether the date can be used."""
    present = F.count_distinct("hour")
    hours = F.collect_set("hour")  # at most 24 values
    expected = F.sequence(F.lit(0), F.lit(23))
    return (df.where(F.col("hour").between(0, 23)).groupBy("date")
            .agg(present.alias("hours_present"), hours.alias("_hours"))
            .select("date", F.col("hours_present").cast("int"),
                    (24 - F.col("hours_present")).cast("int").alias("hours_missing"),
                    F.array_join(F.transform(F.array_except(expected, F.col("_hours")),
                                             lambda h: h.cast("string")), ",").alias("missing"),
                    ((24 - F.col("hours_present")) <= max_missing).alias("accepted")))


def single_member_groups(df: DataFrame, key: str) -> DataFrame:
    """Rows whose key occurs once: one aggregate, no join back."""
    row = F.struct(*[F.col(c) for c in df.columns])
    return (df.groupBy(key).agg(F.count("*").alias("_n"), F.any_value(row).alias("_row"))
            .where("_n = 1").select("_row.*"))
