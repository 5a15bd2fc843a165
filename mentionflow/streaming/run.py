"""Starting, bounding and stopping streams."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.quality import schema_difference
from ..operators.versions import older_than
from ..schemas import BRONZE_STREAM, STREAM_READY_COLUMNS
from ..session import scratch_path
from ..sources import tables
from ..sources.dictionary import Dictionary
from ..sources.streams import SAFE_OPTIONS
from .compaction import PARTITIONS as STREAM_PARTITIONS, STORED
from .events import enrich_stream, event_stream
from .sink import write_batch

# --- Fixed values: trigger, run length, retention ---
TRIGGER = "3 seconds"
RUN_MINUTES = 60
KEEP_HOURS = 1
# --- end of fixed values ---


def checkpoint_path(spark: SparkSession, name: str, root: str | None = None, fresh: bool = False) -> str:
    """Checkpoint folder of a named query. ``fresh`` starts over in a new folder and
    leaves the old one alone; otherwise the query resumes under ``root``."""
    if fresh or root is None:
        return scratch_path(spark, f"checkpoint-{name}")
    return f"{root.rstrip('/')}/checkpoint-{name}"


def start(df: DataFrame, name: str, checkpoint: str, each_batch: Callable | None = None,
          path: str | None = None, fmt: str = "parquet", mode: str = "append",
          trigger: str | None = TRIGGER, options: dict[str, str] | None = None) -> StreamingQuery:
    """Start a query; ``trigger=None`` takes what is available and ends. ``options`` are those of the sink."""
    writer = df.writeStream.queryName(name).outputMode(mode).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=trigger) if trigger else writer.trigger(availableNow=True)
    if each_batch:
        return writer.foreachBatch(each_batch).start()
    writer = writer.format(fmt).options(**(options or {}))
    return (writer if path is None else writer.option("path", path)).start()


def run_stream(query: StreamingQuery, minutes: float | None = RUN_MINUTES) -> bool:
    """Wait for the query up to a time limit, then stop it; True if it ended by itself."""
    try:
        if minutes is None:
            query.awaitTermination()
            return True
        return bool(query.awaitTermination(int(minutes * 60)))
    finally:
        if query.isActive:
            query.stop()


def stream_table_ready(table: DataFrame) -> bool:
    """The stream table has the columns that late additions need."""
    missing = schema_difference(table, BRONZE_STREAM).missing
    return not set(STREAM_READY_COLUMNS) & set(missing)


def clean_stream_table(spark: SparkSession, path: str, hours: int = KEEP_HOURS, now=None) -> dict:
    """Drop (date, hour) partitions older than ``hours``; reports removed and remaining rows."""
    moment = F.current_timestamp() if now is None else now
    cutoff = moment - F.make_dt_interval(hours=F.lit(hours))
    old = older_than(F.col("date"), F.col("hour"), F.to_date(cutoff), F.hour(cutoff))
    return tables.delete_where(spark, path, STORED, old, STREAM_PARTITIONS)


def run_streaming(spark: SparkSession, source: DataFrame, dictionary: Dictionary, root: str,
                  trigger: str | None = TRIGGER, minutes: float | None = None, fresh: bool = False,
                  keep_hours: int | None = None, topic: tuple[str, dict[str, str]] | None = None) -> str:
    """Producer and consumer in a row: enrich events, then count them into the stream table.

    A second run on the same root resumes: each event is counted once over all runs.
    ``fresh`` starts over with a topic and checkpoints of its own and leaves the counts of
    earlier runs alone. The enriched events land in text files under ``root``, or in
    ``topic``, a (format, options) pair such as ``("kafka", {"kafka.bootstrap.servers": …,
    "topic": …, "subscribe": …})``. ``minutes`` bounds a live run (RUN_MINUTES on the
    dashboard); ``keep_hours`` drops older rows of the table first (KEEP_HOURS there). An
    error of either query is raised. Returns the stream table's path.
    """
    root = root.rstrip("/")
    home = f"{root}/runs/{uuid.uuid4().hex}" if fresh else root
    table = tables.table_path(root, "bronze", "streaming_keyword_extractions")
    tables.create_if_absent(spark, table, BRONZE_STREAM, ["date", "hour"])
    if keep_hours is not None:
        clean_stream_table(spark, table, keep_hours)
    fmt, options = topic or ("text", {"path": f"{home}/topic"})
    if topic is None:
        spark.createDataFrame([], "value string").write.mode("append").text(options["path"])
    producer = start(enrich_stream(source, dictionary), "enrich", checkpoint_path(spark, "enrich", home),
                     fmt=fmt, trigger=trigger, options=options)
    if trigger is None:
        run_stream(producer, None)
    landed = spark.readStream.format(fmt).options(**SAFE_OPTIONS if fmt == "kafka" else {}).options(**options).load()
    consumer = start(event_stream(landed.select(F.col("value").cast("string").alias("value")), dictionary), "count",
                     checkpoint_path(spark, "count", home), trigger=trigger,
                     each_batch=write_batch(table, run=home.rsplit("/", 1)[-1] if fresh else "resumed"))
    try:
        run_stream(consumer, minutes if trigger else None)
    finally:
        failure = producer.exception()
        if producer.isActive:
            producer.stop()
    if failure is not None:
        raise failure
    return table
