"""Readers and writers, each a round trip through stored tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ..functions import dates as D
from ..operators.rollups import counts_by
from ..schemas import BRONZE, EVENT, SILVER
from ..session import scratch_path
from ..sources import tables as T
from ..sources.events import read_events, read_hourly, with_provenance
from . import inputs as I
from .registry import check

_BRONZE_COLUMNS = "hour, keyword, mentions, top_repo, repo_mentions, event_mentions, date, source_file"


def _stored_bronze(spark, sf) -> str:
    path = scratch_path(spark, "bronze")
    T.replace_partitions(I.bronze(spark, sf), path, ["date"])
    return path


@check("s1_event_lines", f"""WITH {I.DOCS_SQL}
SELECT doc_id, type, repo, CASE WHEN doc_id % 5 = 0 THEN CAST(len(lines) AS INTEGER) END AS commits,
  CASE WHEN doc_id % 5 = 1 THEN length(text) END AS body_chars FROM doc_ev""")
def s1(spark, sf):
    """Events as gz JSON lines, each followed by a blank and a broken line, read back."""
    path = scratch_path(spark, "archive")
    line = F.to_json(F.struct(*EVENT.fieldNames()))
    lines = F.explode(F.array(line, F.lit("  "), F.concat(F.lit("{\"broken\": "), F.substring(line, 2, 40))))
    I.doc_events(spark, sf).select(lines.alias("value")).write.option("compression", "gzip").text(path)
    events = read_events(spark, path)
    return events.select(
        F.col("id").cast("long").alias("doc_id"), "type", F.col("repo.name").alias("repo"),
        F.when(F.col("type") == "PushEvent", F.size("payload.commits")).alias("commits"),
        F.length("payload.pull_request.body").cast("long").alias("body_chars"))


@check("s2_hourly_extracts", f"""WITH {I.EVENTS_SQL}
SELECT {_BRONZE_COLUMNS} FROM bronze WHERE date = '2024-01-07'""")
def s2(spark, sf):
    """Hourly extract files of all dates are written; one date is read and merged."""
    root = scratch_path(spark, "hourly")
    facts = I.bronze(spark, sf).withColumn("file", D.hourly_name(F.col("date"), F.col("hour")))
    facts.drop("date", "source_file", "processing_time").write.partitionBy("file").parquet(root)
    merged = with_provenance(read_hourly(spark, root, "2024-01-07"), "2024-01-07", I.stamp())
    return merged.select(*_BRONZE_COLUMNS.split(", "))


@check("s3_provenance", f"""SELECT event_id, strftime(ts, '%Y-%m-%d') AS date,
  strftime(ts, '%Y-%m-%d') || '-batch.json.gz' AS source_file FROM events""")
def s3(spark, sf):
    events = I.table(spark, sf, "events")
    return with_provenance(events, D.day(F.col("ts")), I.stamp()).select("event_id", "date", "source_file")


@check("s4_table_scan", f"WITH {I.EVENTS_SQL} SELECT count(*) AS rows FROM bronze")
def s4(spark, sf):
    return T.read_table(spark, _stored_bronze(spark, sf), BRONZE).agg(F.count("*").alias("rows"))


@check("s5_partition_scan", f"""WITH {I.EVENTS_SQL} SELECT {_BRONZE_COLUMNS} FROM bronze
WHERE date = '2024-01-07'""")
def s5(spark, sf):
    stored = T.read_table(spark, _stored_bronze(spark, sf), BRONZE, date="2024-01-07")
    return stored.select(*_BRONZE_COLUMNS.split(", "))


@check("s8_append", f"""WITH {I.EVENTS_SQL}
SELECT date, 2 * count(*) AS rows FROM bronze GROUP BY date""")
def s8(spark, sf):
    path = scratch_path(spark, "append")
    for _ in range(2):
        T.append_table(I.bronze(spark, sf), path, ["date"])
    return counts_by(T.read_table(spark, path, BRONZE), "date")


@check("s9_replace_partitions", f"""WITH {I.SILVER_SQL}
SELECT date, technology, daily_mentions, primary_repository, source_record_count FROM silver""")
def s9(spark, sf):
    """Silver written, half of its dates spoiled, all of it written again: no trace, no duplicates."""
    path = scratch_path(spark, "replace")
    silver = I.silver(spark, sf)
    T.replace_partitions(silver, path, ["date"])
    spoiled = silver.where(F.dayofmonth(F.col("date").cast("date")) > 15).withColumn("daily_mentions", F.lit(0).cast("long"))
    T.replace_partitions(spoiled, path, ["date"])
    T.replace_partitions(silver, path, ["date"])
    return T.read_table(spark, path, SILVER).select(
        "date", "technology", "daily_mentions", "primary_repository", "source_record_count")


@check("s10_empty_table", f"WITH {I.EVENTS_SQL} SELECT count(*) AS rows, CAST(9 AS INTEGER) AS columns FROM bronze")
def s10(spark, sf):
    """Created empty, filled, and left alone when created again."""
    path = scratch_path(spark, "create")
    T.create_if_absent(spark, path, BRONZE, ["date"])
    T.append_table(I.bronze(spark, sf), path, ["date"])
    T.create_if_absent(spark, path, BRONZE, ["date"])
    stored = T.read_table(spark, path, BRONZE)
    return stored.agg(F.count("*").alias("rows"), F.lit(len(stored.columns)).alias("columns"))


@check("s13_name_list", """SELECT name FROM (SELECT DISTINCT p_name AS name FROM part)""")
def s13(spark, sf):
    """A JSON array of part names; their number does not grow with the table."""
    from ..sources.events import read_name_list

    path = scratch_path(spark, "names")
    names = I.table(spark, sf, "part").agg(F.to_json(F.array_sort(F.collect_set("p_name"))).alias("value"))
    names.write.text(path)
    return read_name_list(spark, path).select("name")


@check("s14_typed_round_trip", """SELECT event_id AS id, event_type AS keyword, user_id AS mentions,
  strftime(ts, '%Y-%m-%d') AS date FROM events""")
def s14(spark, sf):
    schema = StructType().add("id", "long").add("keyword", "string").add("mentions", "long").add("date", "string")
    path = scratch_path(spark, "typed")
    I.table(spark, sf, "events").select(
        F.col("event_id").alias("id"), F.col("event_type").alias("keyword"), F.col("user_id").alias("mentions"),
        D.day(F.col("ts")).alias("date")).write.parquet(path)
    return T.read_table(spark, path, schema)


@check("s15_sql_view", """SELECT event_type, count(*) AS rows, CAST(sum(user_id) AS BIGINT) AS users
FROM events GROUP BY event_type""")
def s15(spark, sf):
    T.register(I.table(spark, sf, "events"), "mention_events")
    return spark.sql("SELECT event_type, count(*) AS rows, sum(user_id) AS users FROM mention_events GROUP BY event_type")


@check("s18_rollback", f"""WITH {I.SILVER_SQL}
SELECT date, technology, daily_mentions FROM silver""")
def s18(spark, sf):
    """A rewrite that spoils a date and then fails leaves the date as it was."""
    path = scratch_path(spark, "rollback")
    silver = I.silver(spark, sf)
    T.replace_partitions(silver, path, ["date"])

    def work():
        one = T.read_table(spark, path, SILVER, date="2024-01-07")
        T.replace_partitions(one.withColumn("daily_mentions", F.lit(-1).cast("long")), path, ["date"])
        raise RuntimeError("fails after the write")

    T.with_rollback(spark, path, SILVER, {"date": "2024-01-07"}, work)
    return T.read_table(spark, path, SILVER).select("date", "technology", "daily_mentions")


_CODED = StructType([StructField("c_custkey", LongType()), StructField("part", StringType())])


def _coded_customers(spark, sf, path):
    """Customers in partitions whose folder names need coding: colons, slashes, blanks, NULL."""
    part = F.when(F.col("c_nationkey") > 1, F.concat("c_mktsegment", F.lit(": a/b="), (F.col("c_nationkey") % 3).cast("string")))
    rows = I.table(spark, sf, "customer").select(F.col("c_custkey").cast("long").alias("c_custkey"), part.alias("part"))
    T.replace_partitions(rows, path, ["part"])
    return T.read_table(spark, path, _CODED)


_CODED_SQL = """coded AS (SELECT CAST(c_custkey AS BIGINT) AS c_custkey,
  CASE WHEN c_nationkey > 1 THEN c_mktsegment || ': a/b=' || CAST(c_nationkey % 3 AS VARCHAR) END AS part FROM customer)"""


@check("f4_coded_partitions", f"""WITH {_CODED_SQL}
SELECT c_custkey, part FROM coded WHERE NOT coalesce(part LIKE 'B%' OR c_custkey % 7 = 0, c_custkey % 7 = 0)""")
def f4_coded(spark, sf):
    """Whole partitions and rows of others deleted, NULL partition included."""
    path = scratch_path(spark, "delete-coded")
    _coded_customers(spark, sf, path)
    T.delete_where(spark, path, _CODED, F.coalesce(F.col("part").startswith("B"), F.lit(False)) | (F.col("c_custkey") % 7 == 0), ["part"])
    return T.read_table(spark, path, _CODED)


@check("x8_coded_retention", f"WITH {_CODED_SQL} SELECT c_custkey, part FROM coded WHERE part IS NOT NULL")
def x8_coded(spark, sf):
    """The NULL partition dropped as a folder."""
    path = scratch_path(spark, "drop-coded")
    _coded_customers(spark, sf, path)
    T.drop_partitions(spark, path, [{"part": None}], ["part"])
    return T.read_table(spark, path, _CODED)


@check("f4_delete_rows", f"""WITH {I.SILVER_SQL}
SELECT date, technology, daily_mentions FROM silver
WHERE NOT (date < '2024-01-05' OR (date = '2024-01-20' AND daily_mentions < 8))""")
def f4(spark, sf):
    """Whole dates and part of one date deleted from a stored table."""
    path = scratch_path(spark, "delete")
    T.replace_partitions(I.silver(spark, sf), path, ["date"])
    doomed = (F.col("date") < "2024-01-05") | ((F.col("date") == "2024-01-20") & (F.col("daily_mentions") < 8))
    T.delete_where(spark, path, SILVER, doomed, ["date"])
    return T.read_table(spark, path, SILVER).select("date", "technology", "daily_mentions")
