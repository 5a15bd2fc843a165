"""Streams over the given tables, run until everything available is taken."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.rollups import counts_by
from ..operators.versions import older_than
from ..schemas import BRONZE_STREAM, EVENT
from ..session import scratch_path
from ..sources import tables as T
from ..sources.streams import read_event_stream
from ..streaming import run as S
from ..streaming.compaction import compact, read_stream_table
from ..streaming.events import enrich_stream, event_stream
from ..streaming.sink import write_batch
from ..streaming.windows import dedupe_events, windowed_trends
from . import inputs as I
from .events import REPO_DICTIONARY, _REPO_SQL
from .registry import check


#: Micro-batches that a streamed table is dealt into.
BATCHES = 4


def _land(rows, path):
    """Deals a table into files and returns the options that give each micro-batch its share of them.

    A micro-batch has as many files as the table has splits, so that it keeps as many tasks
    busy as the table's own scan, and no task's part grows with the table.
    """
    splits = max(1, rows.rdd.getNumPartitions())
    rows.repartition(BATCHES * splits).write.parquet(path)
    return {"maxFilesPerTrigger": str(splits)}


def _stream(spark, sf, name):
    """A table as a stream of several micro-batches."""
    rows, path = I.table(spark, sf, name), scratch_path(spark, f"stream-{name}")
    return read_event_stream(spark, "parquet", path, rows.schema, _land(rows, path))


def _raw_documents(spark, sf):
    """Documents as raw event JSON lines, whole texts."""
    events = I.doc_events(spark, sf, _stream(spark, sf, "documents"))
    return events.select(F.to_json(F.struct(*EVENT.fieldNames())).alias("value"))


def _landed(spark, df, name, schema=None):
    """Run a stream into a table and return the table."""
    path = scratch_path(spark, name)
    S.run_stream(S.start(df, name, S.checkpoint_path(spark, name), path=path, trigger=None), None)
    return spark.read.schema(schema or df.schema).parquet(path)


@check("s6_stream_source", "SELECT event_id, event_type, user_id FROM events")
def s6(spark, sf):
    return _landed(spark, _stream(spark, sf, "events").select("event_id", "event_type", "user_id"), "s6")


@check("x1_event_stream", f"""{_REPO_SQL},
hits AS (SELECT doc_id, string_agg(keyword, ',' ORDER BY keyword) AS technologies
         FROM (SELECT * FROM exact UNION ALL SELECT * FROM inside) GROUP BY doc_id)
SELECT CAST(doc_id AS VARCHAR) AS event_id, type AS event_type, repo AS repo_name,
  coalesce(technologies, '') AS technologies FROM doc_ev LEFT JOIN hits USING (doc_id)""")
def x1(spark, sf):
    out = event_stream(_raw_documents(spark, sf), REPO_DICTIONARY)
    return _landed(spark, out.select("event_id", "event_type", "repo_name",
                                     F.array_join("technologies", ",").alias("technologies")), "x1")


def _counted(spark, sf):
    path = scratch_path(spark, "x2")
    out = event_stream(_raw_documents(spark, sf), REPO_DICTIONARY)
    S.run_stream(S.start(out, "x2", S.checkpoint_path(spark, "x2"), each_batch=write_batch(path, now=I.stamp()),
                         trigger=None), None)
    return path


_COUNTS = f"""{_REPO_SQL},
counts AS (SELECT keyword, repo AS top_repo, count(*) AS n
           FROM (SELECT * FROM exact UNION ALL SELECT * FROM inside) JOIN doc_ev USING (doc_id) GROUP BY keyword, repo)"""


@check("x2_batch_sink", f"""{_COUNTS}
SELECT keyword, top_repo, n AS mentions, n AS event_mentions, CAST(0 AS INTEGER) AS hour, CAST(0 AS INTEGER) AS minute,
  'streaming' AS source_file, 'Streaming' AS event_type, '2024-03-01' AS date FROM counts""")
def x2(spark, sf):
    stored = T.read_table(spark, _counted(spark, sf), BRONZE_STREAM)
    return stored.groupBy("keyword", "top_repo", "hour", "minute", "source_file", "event_type",
                          F.col("date").cast("string").alias("date")).agg(
        F.sum("mentions").alias("mentions"), F.sum("event_mentions").alias("event_mentions"))


@check("x2_replayed_batch", f"{_COUNTS} SELECT keyword, CAST(sum(n) AS BIGINT) AS mentions FROM counts GROUP BY keyword")
def x2_replay(spark, sf):
    """The same batch written twice counts once."""
    path = scratch_path(spark, "replay")
    raw = I.doc_events(spark, sf).select(F.to_json(F.struct(*EVENT.fieldNames())).alias("value"))
    write = write_batch(path, now=I.stamp())
    for _ in range(2):
        write(event_stream(raw, REPO_DICTIONARY), 7)
    return (T.read_table(spark, path, BRONZE_STREAM).groupBy("keyword")
            .agg(F.sum("mentions").alias("mentions")))


@check("x2_compacted_batches", f"""{_COUNTS} SELECT keyword, CAST(sum(n) AS BIGINT) AS mentions, CAST(4 AS BIGINT) AS batches, CAST(2 AS INTEGER) AS folders
FROM counts GROUP BY keyword""")
def x2_compacted(spark, sf):
    """Four batches, merged but for the newest one; each of them is then replayed and still counts once."""
    path = scratch_path(spark, "compacted")
    raw = I.doc_events(spark, sf).select(F.pmod(F.xxhash64("id"), F.lit(4)).alias("part"), F.to_json(F.struct(*EVENT.fieldNames())).alias("value"))
    write = write_batch(path, now=I.stamp())
    batch = lambda k: event_stream(raw.where(F.col("part") == k).select("value"), REPO_DICTIONARY)
    for k in range(4):
        write(batch(k), k)
        if k >= 2:
            compact(spark, path)
    for k in range(4):
        write(batch(k), k)
    stored = read_stream_table(spark, path)
    batches = stored.agg(F.count_distinct("batch_id").alias("batches"))
    folders = T.read_table(spark, path, BRONZE_STREAM).agg(F.count_distinct("batch_id").cast("int").alias("folders"))
    return (stored.groupBy("keyword").agg(F.sum("mentions").alias("mentions"))
            .select("*", batches.scalar().alias("batches"), folders.scalar().alias("folders")))


_WINDOWS = """WITH e AS (SELECT epoch_us(ts) // 3000000 * 3 AS slot, event_type FROM events),
w AS (SELECT slot - 3 * i AS start_s, event_type FROM e, (SELECT unnest(generate_series(0, 9)) AS i))
SELECT start_s, start_s + 30 AS end_s, event_type AS keyword, count(*) AS mentions FROM w GROUP BY 1, 2, 3"""


def _timed(df):
    return df.select(F.col("ts").cast("timestamp").alias("event_timestamp"), F.col("event_type").alias("keyword"),
                     "event_id")


def _seconds(df):
    return df.select(F.unix_seconds("window_start").alias("start_s"), F.unix_seconds("window_end").alias("end_s"),
                     "keyword", "mentions")


@check("x6_windowed_trends", _WINDOWS)
def x6(spark, sf):
    return _seconds(windowed_trends(_timed(I.table(spark, sf, "events"))))


@check("x6_windowed_trends_stream", _WINDOWS)
def x6_stream(spark, sf):
    """The windows that the stream appends; a last event long after all others closes them.

    Files hold events of all times, so the lateness is longer than the table's span.
    """
    path, landed = scratch_path(spark, "x6"), scratch_path(spark, "stream-events")
    rows = I.table(spark, sf, "events")
    options = _land(rows, landed)
    rows.groupBy().agg(F.max("event_id").alias("event_id"), (F.max("ts") + F.expr("INTERVAL 4000 DAYS")).alias("ts"), F.lit("closing").alias("event_type")) \
        .select(*[(F.col(c) if c in ("event_id", "ts", "event_type") else F.lit(None)).cast(rows.schema[c].dataType).alias(c) for c in rows.columns]) \
        .write.mode("append").parquet(landed)
    stream = read_event_stream(spark, "parquet", landed, rows.schema, options)
    out = _seconds(windowed_trends(_timed(stream), lateness="2000 days"))
    S.run_stream(S.start(out, "x6", S.checkpoint_path(spark, "x6"), trigger=None,
                         each_batch=lambda df, epoch: df.write.mode("overwrite").parquet(f"{path}/batch={epoch}")), None)
    return spark.read.schema(out.schema).parquet(path).select(*out.columns)


@check("x7_dedupe_events", "SELECT event_id, event_type AS keyword FROM events")
def x7(spark, sf):
    """Every event arrives twice."""
    twice = _timed(I.table(spark, sf, "events")).withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2))))
    return dedupe_events(twice).select("event_id", "keyword")


@check("x7_dedupe_events_stream", "SELECT event_id, event_type AS keyword FROM events")
def x7_stream(spark, sf):
    twice = _timed(_stream(spark, sf, "events")).withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2))))
    return _landed(spark, dedupe_events(twice, lateness="40 days").select("event_id", "keyword"), "x7")


@check("x8_stream_retention", f"""WITH {I.EVENTS_SQL}, cut AS (SELECT max(ts) - INTERVAL 30 HOUR AS c FROM events)
SELECT date, hour, count(*) AS rows FROM ev, cut
WHERE NOT (date < strftime(c, '%Y-%m-%d') OR (date = strftime(c, '%Y-%m-%d') AND hour < extract('hour' FROM c)))
GROUP BY date, hour""")
def x8(spark, sf):
    """A stored table by date and hour, with the old partitions deleted."""
    from pyspark.sql.types import StructType

    path = scratch_path(spark, "x8")
    rows = I.matches(spark, sf).select("keyword", "repo", F.col("date").cast("date"), "hour")
    T.append_table(rows.coalesce(4), path, ["date", "hour"])
    cutoff = I.table(spark, sf, "events").agg(
        (F.max(F.col("ts").cast("timestamp")) - F.expr("interval 30 hours"))).first()[0]
    schema = StructType([f for f in rows.schema.fields])
    T.delete_where(spark, path, schema, older_than(F.col("date"), F.col("hour"), F.lit(cutoff.date()),
                                                   F.lit(cutoff.hour)), ["date", "hour"])
    left = T.read_table(spark, path, schema)
    return counts_by(left.withColumn("date", F.col("date").cast("string")), "date", "hour")


@check("x9_enrich_stream", f"""WITH {I.DOCS_SQL}, {I.DICT_SQL}, {I.SEARCH_SQL}, {I.ANY_SQL}
SELECT doc_id, type, string_agg(keyword, ',' ORDER BY keyword) AS extracted_keywords,
  searchable_text AS searchable_text
FROM any_hits JOIN search USING (doc_id) GROUP BY doc_id, type, searchable_text""")
def x9(spark, sf):
    sent = _landed(spark, enrich_stream(_raw_documents(spark, sf), I.TEXT_DICTIONARY), "x9")
    back = F.from_json("value", "id string, type string, extracted_keywords array<string>, searchable_text string")
    return sent.select(back.alias("e")).select(
        F.col("e.id").cast("long").alias("doc_id"), "e.type",
        F.array_join("e.extracted_keywords", ",").alias("extracted_keywords"), "e.searchable_text")


_RUN_SQL = f"""{_REPO_SQL}, {I.SEARCH_SQL},
kept AS (SELECT DISTINCT doc_id FROM search, rdict
  WHERE list_contains(regexp_extract_all(searchable_text, '[\\p{{L}}\\p{{N}}_]+'), keyword)
     OR (length(keyword) > 3 AND contains(searchable_text, keyword)))
SELECT keyword, repo AS top_repo, count(*) AS mentions
FROM (SELECT * FROM exact UNION ALL SELECT * FROM inside) JOIN doc_ev USING (doc_id)
WHERE doc_id IN (SELECT doc_id FROM kept) GROUP BY keyword, repo"""


@check("g10_streaming_run", _RUN_SQL)
def g10(spark, sf):
    """Producer and consumer: enriched events land, are matched by repository and counted."""
    table = S.run_streaming(spark, _raw_documents(spark, sf), REPO_DICTIONARY, scratch_path(spark, "g10"), trigger=None)
    return (T.read_table(spark, table, BRONZE_STREAM).groupBy("keyword", "top_repo")
            .agg(F.sum("mentions").alias("mentions")))


@check("g10_streaming_restart", _RUN_SQL)
def g10_restart(spark, sf):
    """Two runs on one root, each after half of the events has landed."""
    root, landed = scratch_path(spark, "g10-restart"), scratch_path(spark, "g10-landed")
    events = I.doc_events(spark, sf).select(F.to_json(F.struct(*EVENT.fieldNames())).alias("value"), F.col("id").cast("long").alias("n"))
    for half in (0, 1):
        events.where(F.col("n") % 2 == half).select("value").write.mode("append").text(landed)
        table = S.run_streaming(spark, read_event_stream(spark, "text", landed), REPO_DICTIONARY, root, trigger=None)
    return (T.read_table(spark, table, BRONZE_STREAM).groupBy("keyword", "top_repo")
            .agg(F.sum("mentions").alias("mentions")))
