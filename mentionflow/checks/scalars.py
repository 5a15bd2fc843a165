"""Scalar functions on the given tables: strings, dates, numbers, arrays, JSON, NULLs."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates as D, rules as R
from ..functions.text import tokens
from . import inputs as I
from .registry import check


@check("r7_strings", """SELECT c_custkey, lower(c_mktsegment) AS lowered, trim('  ' || c_name || ' ') AS trimmed,
  substring(c_name, 1, 8) AS head, split_part(c_name, '#', 2) AS number, replace(c_name, '#', ' ') AS spaced,
  contains(c_name, '01') AS has_01, starts_with(c_mktsegment, 'B') AS is_b,
  concat_ws(' ', nullif(c_mktsegment, 'MACHINERY'), c_name) AS joined,
  c_mktsegment || '_' || lpad(CAST(c_custkey AS VARCHAR), 6, '0') AS padded FROM customer""")
def r7(spark, sf):
    name, segment = F.col("c_name"), F.col("c_mktsegment")
    return I.table(spark, sf, "customer").select(
        "c_custkey", F.lower(segment).alias("lowered"),
        F.trim(F.concat(F.lit("  "), name, F.lit(" "))).alias("trimmed"), F.substring(name, 1, 8).alias("head"),
        F.split_part(name, F.lit("#"), F.lit(2)).alias("number"), F.translate(name, "#", " ").alias("spaced"),
        F.contains(name, F.lit("01")).alias("has_01"), F.startswith(segment, F.lit("B")).alias("is_b"),
        F.concat_ws(" ", F.nullif(segment, F.lit("MACHINERY")), name).alias("joined"),
        F.format_string("%s_%06d", segment, "c_custkey").alias("padded"))


@check("r7_words", r"""SELECT doc_id, CAST(len(regexp_extract_all(lower(text), '[\p{L}\p{N}_]+')) AS INTEGER) AS words,
  regexp_extract(lower(text), '[\p{L}\p{N}_]+') AS first_word FROM documents""")
def r7_words(spark, sf):
    words = tokens(F.col("text"))
    return I.table(spark, sf, "documents").select(
        "doc_id", F.size(words).alias("words"), F.coalesce(F.get(words, 0), F.lit("")).alias("first_word"))


@check("r7_file_names", """SELECT event_id,
  strftime(ts, '%Y-%m-%d') || '-' || lpad(CAST(extract('hour' FROM ts) AS VARCHAR), 2, '0') || '.json.gz' AS archive,
  'keywords-' || strftime(ts, '%Y-%m-%d') || '-hour-' || lpad(CAST(extract('hour' FROM ts) AS VARCHAR), 2, '0')
    || '.parquet' AS hourly FROM events""")
def r7_names(spark, sf):
    day, hour = D.day(F.col("ts")), F.hour("ts")
    return I.table(spark, sf, "events").select(
        "event_id", D.archive_name(day, hour).alias("archive"), D.hourly_name(day, hour).alias("hourly"))


@check("r8_file_dates", """SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 2 THEN NULL
  WHEN o_orderkey % 3 = 1 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS file_date FROM orders""")
def r8(spark, sf):
    """Names with a date, with an impossible date, and without any."""
    day = D.day(F.col("o_orderdate"))
    name = (F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit("bronze/x/"), day, F.lit("-7.json.gz")))
            .when(F.col("o_orderkey") % 3 == 1, F.lit("keywords-2024-13-45-hour-01.parquet"))
            .otherwise(F.lit("no-date.parquet")))
    return I.table(spark, sf, "orders").select("o_orderkey", D.file_date(name).alias("file_date"))


@check("r9_dates", """SELECT event_id, strftime(ts, '%Y-%m-%d') AS day,
  strftime(CAST(ts AS DATE) - 6, '%Y-%m-%d') AS week_start, strftime(CAST(ts AS DATE) + 1, '%Y-%m-%d') AS next_day,
  CAST(extract('hour' FROM ts) AS INTEGER) AS hour, CAST(extract('minute' FROM ts) AS INTEGER) AS minute,
  strftime(ts, '%Y-%m-%d %H:%M') AS bucket, CAST(dayofweek(ts) + 1 AS INTEGER) AS weekday,
  CAST(dayofmonth(ts) AS INTEGER) AS month_day, strftime(ts - INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S') AS hour_before
FROM events""")
def r9(spark, sf):
    ts, day = F.col("ts"), D.day(F.col("ts"))
    return I.table(spark, sf, "events").select(
        "event_id", day.alias("day"), D.window_start(day, 7).alias("week_start"), D.shift(day, 1).alias("next_day"),
        F.hour(ts).alias("hour"), F.minute(ts).alias("minute"), D.minute_bucket(ts).alias("bucket"),
        F.dayofweek(ts).alias("weekday"), F.dayofmonth(ts).alias("month_day"),
        F.date_format(ts - F.expr("interval 1 hour"), "yyyy-MM-dd HH:mm:ss").alias("hour_before"))


@check("r10_math", """SELECT o_orderkey, least(greatest(o_totalprice / 1000, 20), 100) AS clipped,
  round_even(CAST(o_orderkey AS DOUBLE) / 16 * 100, 1) AS percent, CAST(floor(o_totalprice) AS BIGINT) AS whole FROM orders""")
def r10(spark, sf):
    price = F.col("o_totalprice")
    return I.table(spark, sf, "orders").select(
        "o_orderkey", R.clip(price / 1000, 20.0, 100.0).alias("clipped"),
        R.completeness_percent(F.col("o_orderkey"), F.lit(16)).alias("percent"), F.floor(price).alias("whole"))


@check("r11_arrays", f"""WITH {I.DOCS_SQL}
SELECT doc_id, CAST(len(lines) AS INTEGER) AS lines, lines[1] AS first_line,
  CAST(len(list_filter(lines, lambda x: x <> '')) AS INTEGER) AS filled,
  CAST(len(list_distinct(lines)) AS INTEGER) AS different, array_to_string(lines[1:3], '|') AS first_three FROM docs""")
def r11(spark, sf):
    lines = F.split("text", "\n")
    return I.table(spark, sf, "documents").select(
        "doc_id", F.size(lines).alias("lines"), F.try_element_at(lines, F.lit(1)).alias("first_line"),
        F.size(F.filter(lines, lambda x: x != "")).alias("filled"),
        F.size(F.array_distinct(lines)).alias("different"), F.array_join(F.slice(lines, 1, 3), "|").alias("first_three"))


@check("r11_explode", """SELECT doc_id, line, count(*) AS n FROM (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents) WHERE line <> '' GROUP BY 1, 2""")
def r11_explode(spark, sf):
    return (I.table(spark, sf, "documents").select("doc_id", F.explode(F.split("text", "\n")).alias("line"))
            .where("line <> ''").groupBy("doc_id", "line").agg(F.count("*").alias("n")))


@check("r12_json", """SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
  '{"event_id":' || event_id || ',"event_type":"' || event_type || '"}' AS document,
  CASE WHEN event_type = 'error' THEN NULL ELSE CAST(json_extract_string(props, '$.k') AS BIGINT) END AS parsed
FROM events""")
def r12(spark, sf):
    """Parsing by path and by schema; the broken documents of the error events become NULL."""
    text = F.when(F.col("event_type") == "error", F.lit("{broken")).otherwise(F.col("props"))
    return I.table(spark, sf, "events").select(
        "event_id", F.get_json_object("props", "$.k").cast("long").alias("k"),
        F.to_json(F.struct("event_id", "event_type")).alias("document"),
        F.from_json(text, "k long")["k"].alias("parsed"))


@check("r13_null_defaults", """SELECT page_id, coalesce(CAST(CASE WHEN page_id % 10 = 2 THEN NULL ELSE 200 END AS INTEGER), -1) AS status,
  coalesce(nullif(split_part(url, '/', 4), 'en'), 'unknown') AS lang FROM pages""")
def r13(spark, sf):
    status = F.when(F.col("page_id") % 10 != 2, F.lit(200))
    return I.table(spark, sf, "pages").select(
        "page_id", F.coalesce(status, F.lit(-1)).alias("status"),
        F.coalesce(F.nullif(F.split_part("url", F.lit("/"), F.lit(4)), F.lit("en")), F.lit("unknown")).alias("lang"))
