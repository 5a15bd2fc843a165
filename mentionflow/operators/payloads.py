"""Landed job-site responses: one row per HTTP response, stored raw."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..schemas import BRONZE_PAYLOAD, conform
from .ranking import add_row_numbers

# --- Fixed values: error length of a report, threads looked at, thread title ---
ERROR_CHARS = 500
RECENT_SUBMISSIONS = 18
HIRING_TITLE = "who is hiring"
# --- end of fixed values ---


def split_responses(df: DataFrame, status: str = "status_code", body: str = "body",
                    error_chars: int | None = None) -> DataFrame:
    """Adds response_data (a good, parseable body) and error_text (the reason otherwise).

    A failed body is kept whole; ``error_chars`` (ERROR_CHARS in a report) cuts it.
    """
    failed = F.col(body) if error_chars is None else F.substring(body, 1, error_chars)
    good = F.col(status) == 200
    parses = F.try_parse_json(F.col(body)).isNotNull()
    error = (F.when(F.col(status).isNull(), failed)
             .when(good & ~parses, F.lit("Invalid JSON response"))
             .when(~good, failed))
    return (df.withColumn("response_data", F.when(good & parses, F.col(body)))
            .withColumn("error_text", error))


def payload_job_count(response: Column) -> Column:
    """Listings in a response: the length of a JSON array, 0 for anything else."""
    return F.coalesce(F.json_array_length(response), F.lit(0))


def envelope(columns: list[str]) -> Column:
    """Compact JSON of the given columns, NULLs kept, the response body nested as JSON."""
    fields = [F.try_parse_json(c).alias(c) if c == "response_data" else F.col(c) for c in columns]
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def to_bronze_payload(df: DataFrame, source: str, date: str, order: str, collected_at: Column,
                      columns: list[str]) -> DataFrame:
    """Bronze rows: a running record id per (source, date) and the response as JSON.

    ``order`` is the arrival number of a response (a non-negative whole number). A source
    that holds most rows is numbered in ranges, not in one task.
    """
    numbered = add_row_numbers(df, order, [source, date], "_n")
    return conform(numbered.select(
        F.format_string("%s_%s_%06d", F.col(source), F.col(date), F.col("_n") - 1).alias("record_id"),
        F.col(source).alias("source_name"), F.col(date).alias("date"),
        collected_at.alias("collection_timestamp"), envelope(columns).alias("raw_response_json"),
    ), BRONZE_PAYLOAD)


def only_new(df: DataFrame, existing: DataFrame, force: bool = False) -> DataFrame:
    """Rows whose (source, date) was not collected before; ``force`` keeps all."""
    if force:
        return df
    seen = existing.select("source_name", "date").distinct()
    return df.join(seen, ["source_name", "date"], "left_anti")


def collection_summary(df: DataFrame) -> DataFrame:
    """Records, successes and success rate per source and date."""
    good = F.count_if(F.col("status_code") == 200)
    return df.groupBy("source_name", "date").agg(
        F.count("*").alias("responses"), good.alias("successful"),
        F.bround(good / F.count("*") * 100, 1).alias("success_rate"))


def pick_thread(user: DataFrame, items: DataFrame, recent: int = RECENT_SUBMISSIONS) -> DataFrame:
    """The newest hiring thread among each user's ``recent`` latest submissions.

    ``user`` has (user_id, submitted array, newest first); ``items`` has (item_id, type,
    title, kids). Looking at 18 submissions is what the operator does, not a row cap.
    """
    looked_at = (user.select("user_id", F.posexplode("submitted").alias("pos", "item_id"))
                 .where(F.col("pos") < recent))
    hiring = items.where((F.col("type") == "story") & F.contains(F.lower("title"), F.lit(HIRING_TITLE)))
    return (looked_at.join(hiring, "item_id").groupBy("user_id")
            .agg(F.min(F.struct("pos", "item_id", "title", "kids")).alias("_t"))
            .select("user_id", "_t.*"))


def thread_comments(threads: DataFrame, items: DataFrame) -> DataFrame:
    """Landed comments of the chosen threads, with their position in the thread."""
    kids = threads.select(F.col("item_id").alias("thread_id"), F.posexplode("kids").alias("pos", "item_id"))
    return kids.join(items.select("item_id", "text"), "item_id")
