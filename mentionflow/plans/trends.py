"""Trailing-window trend tables with ranks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import dates as D, rules as R
from ..operators.ranking import add_dense_ranks
from ..operators.rollups import trend_rollup
from ..schemas import TIMEFRAMES, conform, trend_schema
from ..session import materialize


def window_bounds(gold: DataFrame, analysis_date: str, timeframe: str) -> DataFrame:
    """One row: first day, last day and number of days of a timeframe.

    A trailing window always counts its full length, so a minimum-days test on it can
    never fail; all time counts the distinct dates present.
    """
    days = TIMEFRAMES[timeframe]
    last = F.lit(analysis_date)
    if days is None:
        return gold.where(F.col("date") <= last).agg(
            F.coalesce(F.min("date"), last).alias("start_date"), last.alias("end_date"),
            F.count_distinct("date").cast("int").alias("days"))
    return gold.sparkSession.range(1).select(
        D.window_start(last, days).alias("start_date"), last.alias("end_date"),
        F.lit(days).alias("days"))


def trend_rows(gold: DataFrame, analysis_date: str, timeframe: str) -> DataFrame:
    """Totals per technology inside the window, with the window's bounds.

    The date condition prunes Gold partitions. Noise words leave after aggregation.
    """
    inside = gold.where(D.in_window(F.col("date"), F.lit(analysis_date), TIMEFRAMES[timeframe]))
    frame = window_bounds(gold, analysis_date, timeframe)
    if TIMEFRAMES[timeframe] is None:
        # one scalar subquery, so that Gold is read once more and not once for each bound
        found = frame.select(F.struct("start_date", "end_date", "days")).scalar()
        bounds = [found.getField(c).alias(c) for c in ("start_date", "end_date", "days")]
    else:
        days = TIMEFRAMES[timeframe]
        last = F.lit(analysis_date)
        bounds = [D.window_start(last, days).alias("start_date"), last.alias("end_date"), F.lit(days).alias("days")]
    return trend_rollup(inside).where(R.not_noise(F.col("technology"))).select("*", *bounds)


def window_rows(totals: DataFrame, analysis_date: str, timeframe: str, span: tuple[str, int] | None = None) -> DataFrame:
    """``trend_rows`` of one timeframe from the totals of all (``partials.trailing_totals``).

    ``span`` (first date, number of dates) bounds the all-time window.
    """
    days, last = TIMEFRAMES[timeframe], F.lit(analysis_date)
    if days is None:
        first, days = span or (analysis_date, 0)
        bounds = [F.coalesce(F.lit(first), last).alias("start_date"), last.alias("end_date"), F.lit(days).alias("days")]
    else:
        bounds = [D.window_start(last, days).alias("start_date"), last.alias("end_date"), F.lit(days).alias("days")]
    found = totals.where(F.col(f"`{timeframe}`").isNotNull()).where(R.not_noise(F.col("technology"))).select(
        "technology", "technology_category", F.col(f"`{timeframe}`.total_mentions"),
        (F.col(f"`{timeframe}`.total_mentions") / F.col(f"`{timeframe}`.days_with_activity")).alias("avg_daily_mentions"),
        F.col(f"`{timeframe}`.peak_day_mentions"), F.col(f"`{timeframe}`.days_with_activity"))
    return found.select("*", *bounds)


def rank_trends(rows: DataFrame, analysis_date: str, timeframe: str,
                processed_at: Column | None = None) -> DataFrame:
    """Ranks and signals on ``trend_rows``; reads its input several times."""
    t = timeframe
    ranked = add_dense_ranks(rows, "total_mentions",
                             {"mention_rank": [], "category_rank": ["technology_category"]})
    names = {"start_date": "data_start_date", "end_date": "data_end_date", "days": "total_days_analyzed"}
    if t != "alltime":
        names = {"start_date": "window_start_date", "end_date": "window_end_date"}
    out = ranked.select(
        F.lit(analysis_date).alias("analysis_date"), *[F.col(c).alias(n) for c, n in names.items()],
        "technology", "technology_category",
        F.col("total_mentions").alias(f"total_mentions_{t}"),
        F.col("avg_daily_mentions").alias(f"avg_daily_mentions_{t}"),
        F.col("peak_day_mentions").alias(f"peak_day_mentions_{t}"),
        F.col("days_with_activity").alias(f"days_with_activity_{t}"),
        F.lit("stable").alias(f"trend_direction_{t}"),
        F.col("mention_rank").alias(f"mention_rank_{t}"),
        F.col("category_rank").alias(f"category_rank_{t}"),
        R.hotness(F.col("avg_daily_mentions")).alias(f"hotness_signal_{t}"),
        R.completeness_percent(F.col("days_with_activity"), F.col("days")).alias(f"data_completeness_{t}"),
        (F.current_timestamp() if processed_at is None else processed_at).alias("processed_at"))
    return conform(out, trend_schema(t))


def build_trends(gold: DataFrame, analysis_date: str, timeframe: str,
                 processed_at: Column | None = None) -> DataFrame:
    """The trend table of one timeframe ('7d', '30d', '90d', 'alltime') as of a date.

    The totals (one row per technology) are written to the scratch folder first, so the
    rank branches do not aggregate Gold again. ``trend_direction`` is always 'stable'.
    """
    rows = materialize(trend_rows(gold, analysis_date, timeframe), f"trends-{timeframe}")
    return rank_trends(rows, analysis_date, timeframe, processed_at)
