"""The micro-batch sink of the live mention table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..operators.matching import with_keywords
from ..operators.rollups import stream_counts
from ..schemas import BRONZE_STREAM, conform
from .compaction import merged_upto


def batch_rows(batch: DataFrame, epoch: int, now: Column | None = None) -> DataFrame:
    """Counts of a micro-batch in the stream table's columns.

    All times, window bounds included, are the batch time; there is no event window
    here (see windows.windowed_trends).
    """
    at = F.current_timestamp() if now is None else now
    count = F.col("mention_count").cast("int")
    none = F.lit(None).cast("string")
    rows = stream_counts(with_keywords(batch)).select(
        F.hour(at).alias("hour"), F.minute(at).alias("minute"), "keyword", count.alias("mentions"),
        F.col("repo_name").alias("top_repo"), count.alias("repo_mentions"),
        count.alias("event_mentions"), F.to_date(at).alias("date"),
        F.lit("streaming").alias("source_file"), at.alias("processing_time"), none.alias("event_id"),
        at.alias("event_timestamp"), F.lit("Streaming").alias("event_type"),
        F.lit("streaming").alias("actor_login"), at.alias("kafka_timestamp"),
        F.lit(f"batch_{epoch}").alias("batch_id"), at.alias("window_start"), at.alias("window_end"))
    return conform(rows, BRONZE_STREAM)


def write_batch(path: str, run: str = "default", now: Column | None = None):
    """A foreachBatch function that stores each batch in a folder of its own.

    A replayed batch overwrites its folder, whatever hour it is by then, so the table
    counts it once. ``run`` names the checkpoint the batch numbers belong to: a fresh
    checkpoint starts again at 0 and must not overwrite an earlier run. The batch is
    read once; an empty one adds no rows. Hours are folders, minutes are a column, and
    retention removes old folders.
    A small batch is gathered in one file of an hour, a backlog is written in parallel:
    the rebalance lets AQE choose by size. A batch that a compaction has merged is there
    already and is not written again.
    """
    def write(batch: DataFrame, epoch: int) -> None:
        if epoch <= merged_upto(batch.sparkSession, path, run):
            return
        rows = batch_rows(batch, epoch, now).drop("batch_id").hint("rebalance", "date", "hour")
        (rows.write.mode("overwrite").option("partitionOverwriteMode", "static")
         .partitionBy("date", "hour").parquet(f"{path}/run={run}/batch_id=batch_{epoch}"))

    return write
