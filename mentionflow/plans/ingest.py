"""Landed job-site responses to the Bronze payload table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators.payloads import only_new, split_responses, to_bronze_payload
from ..schemas import BRONZE_PAYLOAD
from ..sources import tables

ENVELOPE = ["api_type", "url", "status_code", "response_data", "error_text", "collected_at",
            "collection_date"]


def payload_rows(responses: DataFrame, collected_at: Column, extra: list[str] = ()) -> DataFrame:
    """Bronze rows of raw responses.

    ``responses``: source_name, collection_date, arrival (whole number), api_type, url,
    status_code, body, collected_at and any ``extra`` envelope columns such as company.
    """
    return to_bronze_payload(split_responses(responses), "source_name", "collection_date", "arrival",
                             collected_at, [*ENVELOPE, *extra])


def ingest_payloads(spark: SparkSession, responses: DataFrame, path: str, collected_at: Column,
                    force: bool = False, extra: list[str] = ()) -> DataFrame:
    """Append the responses of sources and dates not stored yet; returns the stored table.

    With ``force`` the (source, date) pairs in the input replace what was stored.
    """
    rows = payload_rows(responses, collected_at, extra)
    keys = ["source_name", "date"]
    tables.create_if_absent(spark, path, BRONZE_PAYLOAD, keys)
    if force:
        tables.replace_partitions(rows, path, keys)
    else:
        stored = tables.read_table(spark, path, BRONZE_PAYLOAD)
        tables.append_table(only_new(rows, stored), path, keys)
    return tables.read_table(spark, path, BRONZE_PAYLOAD)
