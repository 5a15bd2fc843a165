"""Streaming sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

# --- Fixed values: how the live topic is read ---
TOPIC = "github-events-raw"
KAFKA_OPTIONS = {"startingOffsets": "latest", "failOnDataLoss": "false", "maxOffsetsPerTrigger": "100"}
# --- end of fixed values ---

#: Without other options nothing is skipped, and lost data is an error.
SAFE_OPTIONS = {"startingOffsets": "earliest", "failOnDataLoss": "true"}


def read_event_stream(spark: SparkSession, fmt: str, location: str, schema: StructType | None = None,
                      options: dict[str, str] | None = None) -> DataFrame:
    """Unbounded frame with a string column ``value`` (Kafka, text) or typed columns (files).

    For Kafka ``location`` is the broker list; all of the topic is read unless ``options``
    say otherwise (KAFKA_OPTIONS are those of the live dashboard). For files it is a folder or
    glob, and ``maxFilesPerTrigger`` is the rate limit.
    """
    reader = spark.readStream.format(fmt)
    if fmt == "kafka":
        settings = {"subscribe": TOPIC, **SAFE_OPTIONS, **(options or {})}
        return (reader.options(**settings).option("kafka.bootstrap.servers", location).load()
                .selectExpr("CAST(value AS STRING) AS value"))
    if schema is not None:
        reader = reader.schema(schema)
    return reader.options(**(options or {})).load(location)
