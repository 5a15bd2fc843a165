"""The dashboard queries: short compositions over Silver, trends and the stream table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.dates import minute_bucket
from ..operators import gaps, quality, ranking, rollups
from ..operators.versions import recent

# --- Fixed values: thresholds and categories the dashboards show ---
EXCLUDED_TECHNOLOGY = "github"
GOOD_QUALITY = 50
HIGH_MENTIONS, HIGH_QUALITY = 5000, 51
SAMPLE_CATEGORIES = ["ai_framework", "language", "framework", "database", "blockchain"]
# --- end of fixed values ---

ACTIVITY = ["technology", "daily_mentions", "data_quality_score", "primary_repository"]


def filter_silver(silver: DataFrame, exclude: str | None = None, min_quality: float | None = None,
                  min_mentions: int | None = None) -> DataFrame:
    """Silver rows above the given thresholds; each threshold is exclusive."""
    if exclude is not None:
        silver = silver.where(F.col("technology") != exclude)
    if min_quality is not None:
        silver = silver.where(F.col("data_quality_score") > min_quality)
    if min_mentions is not None:
        silver = silver.where(F.col("daily_mentions") > min_mentions)
    return silver


def quality_leaders(silver: DataFrame, n: int = 20) -> DataFrame:
    """Best quality scores of everything but the excluded technology."""
    return ranking.top_n(
        filter_silver(silver, EXCLUDED_TECHNOLOGY)
        .select("date", "technology", "data_quality_score", "source_record_count"),
        [F.desc("data_quality_score"), "technology", "date"], n)


def good_rows(silver: DataFrame, n: int = 20) -> DataFrame:
    """Most mentioned rows of good quality."""
    return ranking.top_n(
        filter_silver(silver, EXCLUDED_TECHNOLOGY, GOOD_QUALITY).select("date", *ACTIVITY),
        [F.desc("daily_mentions"), "technology", "date"], n)


def heavy_rows(silver: DataFrame, min_mentions: int = HIGH_MENTIONS, min_quality: float = HIGH_QUALITY) -> DataFrame:
    """All rows above the high thresholds."""
    return (filter_silver(silver, None, min_quality, min_mentions).select("date", *ACTIVITY)
            .orderBy(F.desc("daily_mentions"), "technology", "date"))


def top_technologies(gold: DataFrame, n: int = 10) -> DataFrame:
    return rollups.top_by_sum(gold, "technology", "daily_mentions", n)


def layer_facts(df: DataFrame) -> DataFrame:
    """Date range and distinct counts of a layer."""
    return df.agg(F.min("date").alias("first_date"), F.max("date").alias("last_date"),
                  F.count_distinct("date").alias("unique_dates"),
                  F.count_distinct("technology").alias("unique_technologies"))


def top_ranked(trends: DataFrame, timeframe: str = "alltime", n: int = 10) -> DataFrame:
    """The ``n`` best overall ranks with their figures."""
    t = timeframe
    return ranking.top_n(
        trends.select(f"mention_rank_{t}", "technology", "technology_category", f"total_mentions_{t}",
                      f"avg_daily_mentions_{t}", f"peak_day_mentions_{t}", f"days_with_activity_{t}"),
        [f"mention_rank_{t}", "technology", "technology_category"], n)


def category_rank_values(trends: DataFrame, timeframe: str = "alltime") -> DataFrame:
    """How often each category rank occurs."""
    return rollups.counts_by(trends, f"category_rank_{timeframe}").orderBy(f"category_rank_{timeframe}")


def behind_leader(trends: DataFrame, timeframe: str = "alltime", n: int = 20) -> DataFrame:
    """Technologies that do not lead their category."""
    t = timeframe
    return ranking.top_n(
        trends.where(F.col(f"category_rank_{t}") != 1)
        .select("technology", "technology_category", f"total_mentions_{t}", f"mention_rank_{t}",
                f"category_rank_{t}"),
        ["technology_category", f"category_rank_{t}", "technology"], n)


def category_leaders(trends: DataFrame, timeframe: str = "alltime", n: int = 10,
                     categories: list[str] | None = None) -> DataFrame:
    """Best ranks of each listed category: one filter on the stored rank, no loop."""
    t = timeframe
    if categories is not None:
        trends = trends.where(F.col("technology_category").isin(categories))
    return ranking.top_per_group(trends, f"category_rank_{t}", n).select(
        "technology_category", "technology", f"total_mentions_{t}", f"mention_rank_{t}",
        f"category_rank_{t}")


def lone_technologies(trends: DataFrame, timeframe: str = "alltime") -> DataFrame:
    """Technologies alone in their category."""
    return gaps.single_member_groups(
        trends.select("technology", "technology_category", f"category_rank_{timeframe}"),
        "technology_category")


def latest_records(stream: DataFrame, n: int = 10, tie: tuple = ("keyword", "top_repo")) -> DataFrame:
    """Newest rows of the stream table."""
    return ranking.top_n(stream, [F.desc("processing_time"), *tie], n)


def records_per_minute(stream: DataFrame, n: int = 20) -> DataFrame:
    """Row count of the newest minutes."""
    return ranking.top_n(rollups.counts_by(stream, minute_bucket(F.col("processing_time")).alias("minute")),
                         [F.desc("minute")], n)


def last_minute(stream: DataFrame, now: Column | None = None) -> DataFrame:
    return recent(stream, "processing_time", "1 minute", now)


def duplicates(df: DataFrame) -> DataFrame:
    return quality.duplicate_summary(df, ["date", "technology"])
