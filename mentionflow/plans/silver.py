"""Hourly facts to daily keyword trends."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.rules import quality_score
from ..operators.rollups import daily_rollup
from ..schemas import SILVER, conform


def build_silver(bronze: DataFrame, processed_at: Column | None = None) -> DataFrame:
    """Daily rollup with a quality score, all dates in one plan.

    The score compares a keyword with the day's leader. That window runs over daily
    rows, one per dictionary keyword, so even a date that holds most of Bronze is small
    there.
    """
    leader = F.max("daily_mentions").over(Window.partitionBy("date"))
    scored = daily_rollup(bronze).select(
        "date", F.col("keyword").alias("technology"), "daily_mentions", "daily_repo_mentions",
        "daily_event_mentions", "primary_repository",
        quality_score(F.col("daily_mentions"), leader, F.col("source_record_count")).alias("data_quality_score"),
        "source_record_count",
        (F.current_timestamp() if processed_at is None else processed_at).alias("processed_at"),
        F.lit("bronze_batch").alias("source_layer"))
    return conform(scored, SILVER)
