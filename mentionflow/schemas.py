"""Table schemas of every layer (fixed values: column names, types, nullability)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import (
    ArrayType, DateType, DoubleType, IntegerType, LongType, StringType,
    StructField, StructType, TimestampType,
)

_TYPES = {
    "string": StringType(), "int": IntegerType(), "long": LongType(),
    "double": DoubleType(), "timestamp": TimestampType(), "date": DateType(),
}


def _schema(required: str, optional: str = "", order: str = "") -> StructType:
    """``required`` / ``optional`` are 'name type' lists; ``order`` fixes the sequence."""
    fields = {}
    for text, nullable in ((required, False), (optional, True)):
        for part in filter(None, (p.strip() for p in text.split(","))):
            name, kind = part.split()
            fields[name] = StructField(name, _TYPES[kind], nullable)
    names = order.split() or list(fields)
    return StructType([fields[n] for n in names])


_TEXT = StringType()

# Event document as it arrives, one JSON object per line.
EVENT = StructType([
    StructField("id", _TEXT),
    StructField("type", _TEXT),
    StructField("actor", StructType([StructField("login", _TEXT)])),
    StructField("repo", StructType([StructField("name", _TEXT)])),
    StructField("payload", StructType([
        StructField("commits", ArrayType(StructType([StructField("message", _TEXT)]))),
        StructField("pull_request", StructType([
            StructField("title", _TEXT),
            StructField("body", _TEXT),
            StructField("head", StructType([StructField("ref", _TEXT)])),
        ])),
        StructField("description", _TEXT),
        StructField("ref", _TEXT),
        StructField("release", StructType([
            StructField("name", _TEXT), StructField("tag_name", _TEXT)])),
        StructField("issue", StructType([StructField("title", _TEXT)])),
    ])),
])

BRONZE = _schema(
    "hour int, keyword string, mentions long, top_repo string, repo_mentions long, "
    "event_mentions long, date string, source_file string, processing_time timestamp")

BRONZE_STREAM = _schema(
    "hour int, minute int, keyword string, mentions int, top_repo string, "
    "date date, processing_time timestamp",
    "repo_mentions int, event_mentions int, source_file string, event_id string, "
    "event_timestamp timestamp, event_type string, actor_login string, "
    "kafka_timestamp timestamp, batch_id string, window_start timestamp, window_end timestamp",
    "hour minute keyword mentions top_repo repo_mentions event_mentions date source_file "
    "processing_time event_id event_timestamp event_type actor_login kafka_timestamp "
    "batch_id window_start window_end")

STREAM_READY_COLUMNS = ["event_id", "event_timestamp", "kafka_timestamp", "batch_id"]

BRONZE_PAYLOAD = _schema(
    "record_id string, source_name string, date string, collection_timestamp string, "
    "raw_response_json string")

SILVER = _schema(
    "date string, technology string, daily_mentions long, daily_repo_mentions long, "
    "daily_event_mentions long, data_quality_score double, source_record_count int, "
    "processed_at timestamp, source_layer string",
    "primary_repository string",
    "date technology daily_mentions daily_repo_mentions daily_event_mentions "
    "primary_repository data_quality_score source_record_count processed_at source_layer")

GOLD = _schema(
    "date string, technology string, daily_mentions long, daily_repo_mentions long, "
    "daily_event_mentions long, technology_category string, mention_volume string, "
    "data_completeness string, processed_at timestamp, data_source string",
    "primary_repository string",
    "date technology daily_mentions daily_repo_mentions daily_event_mentions "
    "primary_repository technology_category mention_volume data_completeness "
    "processed_at data_source")

# Mergeable partials of Gold by span of dates (not part of the fixed layers).
PARTIALS = _schema(
    "technology string, technology_category string, mentions long, peak long, active long, "
    "span string, date string")

TIMEFRAMES = {"7d": 7, "30d": 30, "90d": 90, "alltime": None}


def trend_schema(timeframe: str) -> StructType:
    """Analytics table of one timeframe; alltime and 7d differ in a few columns."""
    t = timeframe
    if t == "alltime":
        return _schema(
            "analysis_date string, data_start_date string, data_end_date string, "
            "total_days_analyzed int, technology string, technology_category string, "
            "total_mentions_alltime long, avg_daily_mentions_alltime double, "
            "peak_day_mentions_alltime long, days_with_activity_alltime int, "
            "mention_rank_alltime int, category_rank_alltime int, "
            "data_completeness_alltime double, processed_at timestamp")
    hotness = "hotness_signal_7d string, " if t == "7d" else ""
    return _schema(
        "analysis_date string, window_start_date string, window_end_date string, "
        "technology string, technology_category string, "
        f"total_mentions_{t} long, avg_daily_mentions_{t} double, peak_day_mentions_{t} long, "
        f"days_with_activity_{t} int, trend_direction_{t} string, mention_rank_{t} int, "
        f"category_rank_{t} int, {hotness}data_completeness_{t} double, processed_at timestamp")


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Project to the schema's columns, order and types; fails on a missing column."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
