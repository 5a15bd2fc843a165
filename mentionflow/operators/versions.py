"""Row versions, retention and deletion predicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def read_as_of(log: DataFrame, keys: list[str], time: str, moment) -> DataFrame:
    """State of an append-only version log at a moment: the newest row of each key.

    Ties on the time are settled by the row's values, so a rerun gives the same row.
    """
    rest = [c for c in log.columns if c not in keys and c != time]
    newest = F.max(F.struct(time, *rest)).alias("_row")
    return (log.where(F.col(time) <= moment).groupBy(*keys).agg(newest)
            .select(*keys, "_row.*").select(*log.columns))


def older_than(date: Column, hour: Column, cutoff_date: Column, cutoff_hour: Column) -> Column:
    """True for (date, hour) partitions before the cutoff hour."""
    return (date < cutoff_date) | ((date == cutoff_date) & (hour < cutoff_hour))


def retain_hours(df: DataFrame, now: Column, hours: int) -> DataFrame:
    """Rows of the partitions from ``now - hours`` on."""
    cutoff = now - F.make_dt_interval(hours=F.lit(hours))
    return df.where(~older_than(F.col("date"), F.col("hour"),
                                F.date_format(cutoff, "yyyy-MM-dd").cast(df.schema["date"].dataType),
                                F.hour(cutoff)))


def retention_report(df: DataFrame, now: Column, hours: int) -> DataFrame:
    """Rows removed and remaining under ``retain_hours``."""
    cutoff = now - F.make_dt_interval(hours=F.lit(hours))
    old = older_than(F.col("date"), F.col("hour"),
                     F.date_format(cutoff, "yyyy-MM-dd").cast(df.schema["date"].dataType), F.hour(cutoff))
    return df.agg(F.count_if(old).alias("removed"), (F.count("*") - F.count_if(old)).alias("remaining"))


def without(df: DataFrame, predicate: Column) -> DataFrame:
    """What a DELETE leaves: rows where the predicate is false or unknown."""
    return df.where(~F.coalesce(predicate, F.lit(False)))


def recent(df: DataFrame, time: str, interval: str, now: Column | None = None) -> DataFrame:
    """Rows within the last interval ('1 minute') before ``now`` (default: the clock)."""
    moment = F.current_timestamp() if now is None else now
    return df.where(F.col(time) >= moment - F.expr(f"interval {interval}"))
