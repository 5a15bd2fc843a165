"""Event archives, hourly extracts and name lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructField, StructType, StringType

from ..functions import dates as D
from ..functions.base import explode_if
from ..schemas import EVENT

_BROKEN = "_broken"


def parse_events(lines: DataFrame, column: str = "value") -> DataFrame:
    """Nested events from JSON lines; blank and malformed lines are skipped.

    A malformed line parses to a struct of NULLs, so it is recognised by the
    corrupt-record field, not by a NULL result.
    """
    schema = StructType([*EVENT.fields, StructField(_BROKEN, StringType())])
    event = F.from_json(F.col(column), schema, {"columnNameOfCorruptRecord": _BROKEN})
    rest = [c for c in lines.columns if c != column]
    return (lines.where(F.length(F.trim(column)) > 0)
            .select(*rest, explode_if(event, lambda e: e.isNotNull() & e[_BROKEN].isNull()).alias("event"))
            .select(*rest, *[f"event.{name}" for name in EVENT.fieldNames()]))


def read_events(spark: SparkSession, path: str) -> DataFrame:
    """Event archive files (NDJSON, plain or gz) with their date and hour.

    Date and hour come from the file name ``YYYY-MM-DD-H.json.gz``. A gz file is one
    task, which is why archives are kept hourly.
    """
    name = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)
    lines = spark.read.text(path).select(
        "value",
        F.date_format(D.file_date(name), "yyyy-MM-dd").alias("date"),
        F.try_to_number(F.nullif(F.regexp_extract(name, r"\d{4}-\d{2}-\d{2}-(\d{1,2})", 1), F.lit("")),
                        F.lit("99")).cast("int").alias("hour"))
    return parse_events(lines)


def read_hourly(spark: SparkSession, root: str, date: str) -> DataFrame:
    """The hourly keyword extracts of one date, merged; one scan, no driver round trip."""
    return spark.read.parquet(f"{root.rstrip('/')}/*keywords-{date}-hour-*.parquet")


def with_provenance(df: DataFrame, date: Column | str, processing_time: Column | None = None) -> DataFrame:
    """Adds the date, the batch file name and the processing time."""
    day = F.lit(date) if isinstance(date, str) else date
    return (df.withColumn("date", day)
            .withColumn("source_file", F.concat(day, F.lit("-batch.json.gz")))
            .withColumn("processing_time", F.current_timestamp() if processing_time is None
                        else processing_time))


def read_name_list(spark: SparkSession, path: str) -> DataFrame:
    """Names of a JSON array file, one per row, in order."""
    return (spark.read.text(path, wholetext=True)
            .select(F.posexplode(F.from_json("value", "array<string>")).alias("ordinal", "name")))


def to_enriched_json(df: DataFrame, event_columns: list[str], keywords: str = "technologies",
                     filter_timestamp: Column | None = None, stored_chars: int | None = None) -> DataFrame:
    """One JSON document per event: the event plus keywords and searchable text.

    ``stored_chars`` limits the searchable text that the document keeps.
    """
    text = F.col("searchable_text")
    clock = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return df.select(F.to_json(F.struct(
        *event_columns, F.col(keywords).alias("extracted_keywords"),
        (text if stored_chars is None else F.substring(text, 1, stored_chars)).alias("searchable_text"),
        (clock if filter_timestamp is None else filter_timestamp).alias("filter_timestamp"),
        F.lit("2.0_enhanced").alias("producer_version"))).alias("value"))
