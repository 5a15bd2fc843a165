"""Landed job-site responses and hiring threads."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import payloads as P
from ..plans.ingest import ingest_payloads, payload_rows
from ..session import scratch_path
from . import inputs as I
from .registry import check


@check("p13_split_responses", f"""WITH {I.RESPONSES_SQL}
SELECT arrival, status_code, response_data, error_text FROM split""")
def p13(spark, sf):
    return P.split_responses(I.responses(spark, sf)).select("arrival", "status_code", "response_data", "error_text")


_ROWS = f"""WITH {I.RESPONSES_SQL},
rows AS (SELECT *, source_name || '_' || collection_date || '_' || lpad(CAST(
    row_number() OVER (PARTITION BY source_name, collection_date ORDER BY arrival) - 1 AS VARCHAR), 6, '0')
    AS record_id FROM split)"""


@check("s11_payload_rows", f"""{_ROWS}
SELECT record_id, source_name, collection_date AS date, collection_date || 'T01:00:00+00:00' AS collection_timestamp,
  api_type, url, status_code, response_data, error_text FROM rows""")
def s11(spark, sf):
    """Bronze rows, with the stored JSON read back by field."""
    stamp = F.concat("collection_date", F.lit("T01:00:00+00:00"))
    rows = payload_rows(I.responses(spark, sf), stamp)
    back = "api_type string, url string, status_code int, response_data string, error_text string"
    return (rows.withColumn("e", F.from_json("raw_response_json", back))
            .select("record_id", "source_name", "date", "collection_timestamp", "e.*"))


@check("s19_only_new", f"""{_ROWS}
SELECT record_id FROM rows WHERE (source_name, collection_date) NOT IN (
  SELECT source_name, collection_date FROM responses WHERE status_code IS NULL)""")
def s19(spark, sf):
    """Sources and dates with a timeout count as collected before."""
    stamp = F.concat("collection_date", F.lit("T01:00:00+00:00"))
    responses = I.responses(spark, sf)
    stored = responses.where("status_code IS NULL").select("source_name", F.col("collection_date").alias("date"))
    return P.only_new(payload_rows(responses, stamp), stored).select("record_id")


@check("a21_job_count", f"""WITH {I.DOCS_SQL}
SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN CAST(len(lines) AS INTEGER) ELSE 0 END AS job_count FROM doc_ev""")
def a21(spark, sf):
    """Commit lists stand for listings; the other events are no arrays."""
    events = I.doc_events(spark, sf)
    listing = F.when(F.col("type") == "PushEvent", F.to_json("payload.commits")).otherwise(F.to_json("payload"))
    return events.select(F.col("id").cast("long").alias("doc_id"), P.payload_job_count(listing).alias("job_count"))


@check("a17_success_rate", f"""WITH {I.RESPONSES_SQL}
SELECT source_name, collection_date AS date, count(*) AS responses,
  count(*) FILTER (WHERE status_code = 200) AS successful,
  round_even(CAST(count(*) FILTER (WHERE status_code = 200) AS DOUBLE) / count(*) * 100, 1) AS success_rate
FROM responses GROUP BY 1, 2""")
def a17(spark, sf):
    return P.collection_summary(I.responses(spark, sf).withColumnRenamed("collection_date", "date"))


@check("r14_hiring_thread", f"""WITH {I.THREADS_SQL}
SELECT CAST(user_id AS BIGINT) AS user_id, CAST(pos AS INTEGER) AS pos, item_id, title FROM picked""")
def r14(spark, sf):
    return P.pick_thread(I.thread_users(spark, sf), I.thread_items(spark, sf)).drop("kids")


@check("j8_thread_comments", f"""WITH {I.THREADS_SQL}
SELECT p.item_id AS thread_id, CAST(i.turn - 1 AS INTEGER) AS pos, i.item_id, i.text
FROM picked p JOIN items i ON i.conv_id = p.item_id AND i.turn > 0""")
def j8(spark, sf):
    items = I.thread_items(spark, sf)
    return P.thread_comments(P.pick_thread(I.thread_users(spark, sf), items), items)


@check("g8_ingest", f"""{_ROWS}
SELECT source_name, collection_date AS date, count(*) AS records, min(record_id) AS first_id, max(record_id) AS last_id
FROM rows GROUP BY 1, 2""")
def g8(spark, sf):
    """Listings first, then everything twice: each source and date is stored once."""
    path = scratch_path(spark, "payloads")
    stamp = F.concat("collection_date", F.lit("T01:00:00+00:00"))
    responses = I.responses(spark, sf)
    ingest_payloads(spark, responses.where("source_name = 'listings'"), path, stamp)
    ingest_payloads(spark, responses, path, stamp)
    stored = ingest_payloads(spark, responses, path, stamp)
    return stored.groupBy("source_name", "date").agg(
        F.count("*").alias("records"), F.min("record_id").alias("first_id"), F.max("record_id").alias("last_id"))
