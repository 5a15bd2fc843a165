"""Aggregations. All start with a partial aggregate, so a hot key shrinks before it moves."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import IntegralType


def repo_keyword_counts(matches: DataFrame) -> DataFrame:
    """Events per (date, hour, keyword, repository), with the earliest event sequence number."""
    return (matches.groupBy("date", "hour", "keyword", "repo")
            .agg(F.count("*").alias("repo_mentions"), F.min("event_seq").alias("first_seen")))


def hourly_keyword_rollup(matches: DataFrame) -> DataFrame:
    """Hourly mentions, leading repository and hour total per keyword.

    ``matches`` has one row per event and keyword: date, hour, keyword, repo, event_seq.
    The leading repository has the most mentions; a tie goes to the repository whose
    event came first, then to the smaller name. The hour total counts all matches of
    the hour, so it is equal for every keyword. Its window holds at most one row per
    keyword of the dictionary.
    """
    place = F.struct((-F.col("repo_mentions")).alias("n"), "first_seen", "repo")
    per_keyword = (repo_keyword_counts(matches)
                   .groupBy("date", "hour", "keyword")
                   .agg(F.sum("repo_mentions").alias("mentions"), F.min(place).alias("lead")))
    hour_total = F.sum("mentions").over(Window.partitionBy("date", "hour"))
    return per_keyword.select(
        F.col("hour").cast("int").alias("hour"), "keyword", "mentions",
        F.col("lead.repo").alias("top_repo"), (-F.col("lead.n")).alias("repo_mentions"),
        hour_total.alias("event_mentions"), "date")


def first_by(value: str, order: str) -> Column:
    """First non-null value in arrival order; equal positions go to the smaller value."""
    pair = F.struct(F.col(order), F.col(value))
    return F.min(F.when(F.col(value).isNotNull(), pair))[value]


def daily_rollup(bronze: DataFrame) -> DataFrame:
    """Daily sums, hour records and first repository per keyword, all dates in one pass."""
    return (bronze.where("date IS NOT NULL AND keyword IS NOT NULL")
            .groupBy("date", "keyword")
            .agg(F.sum("mentions").alias("daily_mentions"),
                 F.sum("repo_mentions").alias("daily_repo_mentions"),
                 F.sum("event_mentions").alias("daily_event_mentions"),
                 first_by("top_repo", "hour").alias("primary_repository"),
                 F.count("hour").alias("source_record_count")))


def trend_rollup(gold: DataFrame) -> DataFrame:
    """Total, mean, peak and active rows per technology; the mean is over rows present."""
    return (gold.where("technology IS NOT NULL AND technology_category IS NOT NULL")
            .groupBy("technology", "technology_category")
            .agg(F.sum("daily_mentions").alias("total_mentions"),
                 F.avg("daily_mentions").alias("avg_daily_mentions"),
                 F.max("daily_mentions").alias("peak_day_mentions"),
                 F.count("date").alias("days_with_activity")))


def stream_counts(df: DataFrame) -> DataFrame:
    """Events per (keyword, repository) of one micro-batch."""
    return (df.select(F.explode("technologies").alias("keyword"), "event_id", "repo_name")
            .groupBy("keyword", "repo_name").agg(F.count("event_id").alias("mention_count")))


def counts_by(df: DataFrame, *keys: str | Column) -> DataFrame:
    """Row count per key, e.g. per date, per (date, hour) or per minute."""
    return df.groupBy(*keys).agg(F.count("*").alias("rows"))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, most frequent first; missing values are not counted."""
    return (counts_by(df.where(F.col(column).isNotNull()), column)
            .orderBy(F.desc("rows"), column))


def top_by_sum(df: DataFrame, key: str, value: str, n: int = 10) -> DataFrame:
    """The ``n`` keys with the largest sums."""
    return (df.groupBy(key).agg(F.sum(value).alias("total"))
            .orderBy(F.desc("total"), key).limit(n))


def bounds(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.min(column).alias("earliest"), F.max(column).alias("latest"))


def latest(df: DataFrame, column: str):
    """Largest value of a column as a Python value (one number leaves the cluster)."""
    return df.agg(F.max(column)).first()[0]


def summary(df: DataFrame, column: str) -> DataFrame:
    """Count, mean, standard deviation, minimum and maximum."""
    c = F.col(column)
    return df.agg(F.count(c).alias("count"), F.avg(c).alias("mean"), F.stddev(c).alias("stddev"),
                  F.min(c).alias("min"), F.max(c).alias("max"))


def rate(df: DataFrame, predicate: Column) -> DataFrame:
    """Share of rows that satisfy the predicate, in percent; 0 for no rows."""
    hits = F.count_if(predicate)
    rows = F.count("*")
    return df.agg(hits.alias("hits"), rows.alias("rows"),
                  F.when(rows > 0, hits / rows * 100).otherwise(F.lit(0.0)).alias("percent"))


def range_stats(numbers: DataFrame, column: str, keep: Column) -> DataFrame:
    """Count, sum and maximum of the kept numbers and the sum of their squares.

    Both sums of whole numbers are decimals, as the squares of a few million ids pass 64 bits.
    """
    x = F.col(column)
    whole = isinstance(numbers.schema[column].dataType, IntegralType)
    wide = x.cast("decimal(19,0)") if whole else x
    return numbers.where(keep).agg(
        F.count(x).alias("kept"), F.sum(wide).alias("total"), F.max(x).alias("largest"),
        F.sum(wide * wide).alias("squares"))


def as_long(df: DataFrame, *columns: str) -> DataFrame:
    """Whole decimals as long where every value of the column fits; others stay as they are.

    One row of flags leaves the cluster.
    """
    fits = df.agg(*[F.coalesce(F.bool_and(F.col(c).between(-2**63, 2**63 - 1)), F.lit(True)).alias(c) for c in columns]).first()
    return df.withColumns({c: F.col(c).cast("long") for c in columns if fits[c]})


def profile(df: DataFrame, unique: list[str], times: list[str] = ()) -> DataFrame:
    """One-row table profile: rows, columns, distinct keys, latest times."""
    return df.agg(F.count("*").alias("row_count"), F.lit(len(df.columns)).alias("column_count"),
                  *[F.count_distinct(c).alias(f"unique_{c}") for c in unique],
                  *[F.max(c).alias(f"latest_{c}") for c in times])
