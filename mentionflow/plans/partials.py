"""Mergeable partials of Gold, from which all trailing windows are made in one pass.

A partial holds, per technology and category, the sum, the maximum and the number of Gold
rows of a span of dates. Spans are days and closed months: a new day adds the partials of
that day, read from one Gold partition, and a window takes whole months where they lie
inside it and days at its ends. Sums, maxima and counts merge without loss, so every trend
is that of the Gold rows themselves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import dates as D
from ..schemas import TIMEFRAMES

DAY, MONTH = "day", "month"
KEYS = ["technology", "technology_category"]


def day_partials(gold: DataFrame) -> DataFrame:
    """One row per date, technology and category: ``mentions``, ``peak``, ``active`` (rows)."""
    return (gold.where("date IS NOT NULL AND technology IS NOT NULL AND technology_category IS NOT NULL")
            .groupBy("date", *KEYS)
            .agg(F.sum("daily_mentions").alias("mentions"), F.max("daily_mentions").alias("peak"), F.count("date").alias("active"))
            .select(*KEYS, "mentions", "peak", "active", F.lit(DAY).alias("span"), "date"))


def month_of(date: Column) -> Column:
    """First day of a date's month, as text."""
    return F.concat(F.substring(date, 1, 7), F.lit("-01"))


def month_partials(days: DataFrame) -> DataFrame:
    """Day partials merged by month; ``date`` is the month's first day."""
    return (days.groupBy(month_of(F.col("date")).alias("date"), *KEYS)
            .agg(F.sum("mentions").alias("mentions"), F.max("peak").alias("peak"), F.sum("active").alias("active"))
            .select(*KEYS, "mentions", "peak", "active", F.lit(MONTH).alias("span"), "date"))


def _inside(timeframe: str, last: Column) -> Column:
    """Whether a partial counts for a window: a month that lies in it, or a day that no such month covers."""
    days = TIMEFRAMES[timeframe]
    date = F.col("date")
    first = F.lit("") if days is None else D.window_start(last, days)
    month, month_end = month_of(date), F.last_day(F.to_date(month_of(date))).cast("string")
    whole = (month >= first) & (month_end <= last) & F.col("closed")
    return (date >= first) & (date <= last) & F.when(F.col("span") == MONTH, whole).otherwise(~whole)


def trailing_totals(partials: DataFrame, analysis_date: str, months: list[str] = (), timeframes: list[str] = tuple(TIMEFRAMES)) -> DataFrame:
    """One row per technology and category with a struct per timeframe: ``total_mentions``, ``peak_day_mentions``, ``days_with_activity``.

    ``months`` are those that have month partials; the partials are read once for all
    timeframes, and partials that no window needs are not read at all. A struct is NULL
    where the window has no rows.
    """
    last = F.lit(analysis_date)
    closed = month_of(F.col("date")).isin(list(months)) if months else F.lit(False)
    rows = partials.withColumn("closed", closed)
    flags = {t: _inside(t, last) for t in timeframes}
    anywhere = flags[timeframes[0]]
    for t in timeframes[1:]:
        anywhere = anywhere | flags[t]
    sums = []
    for t, flag in flags.items():
        when = lambda c, flag=flag: F.when(flag, F.col(c))
        sums += [F.sum(when("mentions")).alias(f"total_{t}"), F.max(when("peak")).alias(f"peak_{t}"), F.sum(when("active")).alias(f"active_{t}")]
    merged = rows.where(anywhere).groupBy(*KEYS).agg(*sums)
    return merged.select(*KEYS, *[F.when(F.col(f"active_{t}") > 0, F.struct(
        F.col(f"total_{t}").alias("total_mentions"), F.col(f"peak_{t}").alias("peak_day_mentions"),
        F.col(f"active_{t}").alias("days_with_activity"))).alias(t) for t in timeframes])


def date_span(partials: DataFrame, analysis_date: str) -> DataFrame:
    """First date and number of dates up to the analysis date; reads partition values only where ``date`` is one."""
    days = partials.where((F.col("span") == DAY) & (F.col("date") <= analysis_date)).select("date").distinct()
    return days.agg(F.min("date").alias("first"), F.count("*").cast("int").alias("days"))
