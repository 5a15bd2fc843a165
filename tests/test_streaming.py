import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from mentionflow.schemas import BRONZE_STREAM
from mentionflow.sources import tables as T
from mentionflow.sources.dictionary import Dictionary
from mentionflow.sources.streams import KAFKA_OPTIONS, read_event_stream
from mentionflow.streaming import run as S
from mentionflow.streaming.events import event_stream
from mentionflow.streaming.sink import batch_rows, write_batch
from mentionflow.streaming.windows import dedupe_events, windowed_trends

DICTIONARY = Dictionary.of([("python", "language"), ("go", "language")])


def lines(*repos):
    return [json.dumps({"id": str(i), "type": "PushEvent", "repo": {"name": r}, "payload": {"commits": []}})
            for i, r in enumerate(repos)]


def land(folder, name, rows):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(rows) + "\n")


def stored(spark, path):
    return T.read_table(spark, path, BRONZE_STREAM)


def test_batches_append_and_runs_do_not_collide(spark, tmp_path):
    source, path = tmp_path / "in", str(tmp_path / "table")
    land(source, "a.txt", lines("x/python", "x/python", "y/go", "none/none"))
    raw = read_event_stream(spark, "text", str(source), options={"maxFilesPerTrigger": "1"})
    checkpoint = str(tmp_path / "checkpoint-1")

    def run(where, name):
        query = S.start(event_stream(raw, DICTIONARY), name, where, each_batch=write_batch(path, name), trigger=None)
        assert S.run_stream(query, None)

    run(checkpoint, "one")
    assert {(r["keyword"], r["mentions"]) for r in stored(spark, path).collect()} == {("python", 2), ("go", 1)}
    land(source, "b.txt", lines("z/python"))
    run(checkpoint, "one")
    assert stored(spark, path).agg(F.sum("mentions")).first()[0] == 4
    assert {r[0] for r in stored(spark, path).select("batch_id").collect()} == {"batch_0", "batch_1"}
    run(checkpoint, "one")
    assert stored(spark, path).agg(F.sum("mentions")).first()[0] == 4
    assert S.stream_table_ready(stored(spark, path))


def test_replayed_batch_in_a_later_hour_counts_once(spark, tmp_path):
    path = str(tmp_path / "table")
    raw = spark.createDataFrame([(x,) for x in lines("x/python")], "value string")
    for hour in (10, 11):
        at = F.lit(f"2024-01-01 {hour}:59:59").cast("timestamp")
        write_batch(path, "r", at)(event_stream(raw, DICTIONARY), 3)
    [row] = stored(spark, path).collect()
    assert (row["hour"], row["mentions"], row["batch_id"]) == (11, 1, "batch_3")


def test_empty_batch(spark, tmp_path):
    path = str(tmp_path / "table")
    raw = spark.createDataFrame([(x,) for x in lines("none/none")], "value string")
    write_batch(path)(event_stream(raw, DICTIONARY), 0)
    assert stored(spark, path).count() == 0


def test_batch_columns(spark):
    raw = spark.createDataFrame([("not json",), *[(x,) for x in lines("a/go-python")]], "value string")
    rows = batch_rows(event_stream(raw, DICTIONARY), 5, F.lit("2024-01-01 10:20:30").cast("timestamp"))
    assert rows.schema.simpleString() == BRONZE_STREAM.simpleString()
    assert {(r["keyword"], r["hour"], r["minute"], r["event_id"]) for r in rows.collect()} == {
        ("go", 10, 20, None), ("python", 10, 20, None)}
    unknown = event_stream(raw, DICTIONARY).where("event_id = 'unknown'").first()
    assert unknown["repo_name"] == "unknown" and unknown["technologies"] == []


def test_retention_drops_old_hours(spark, tmp_path):
    path = str(tmp_path / "table")
    raw = spark.createDataFrame([(x,) for x in lines("x/python")], "value string")
    for epoch, hour in enumerate((8, 10, 11)):
        write_batch(path, "r", F.lit(f"2024-01-01 {hour}:30:00").cast("timestamp"))(event_stream(raw, DICTIONARY), epoch)
    found = S.clean_stream_table(spark, path, 1, F.lit("2024-01-01 11:45:00").cast("timestamp"))
    assert found == {"removed": 1, "remaining": 2}
    assert sorted(r["hour"] for r in stored(spark, path).collect()) == [10, 11]
    assert not list((tmp_path / "table").glob("run=r/batch_id=batch_0/date=*/hour=*"))


def test_bounded_run_stops(spark, tmp_path):
    land(tmp_path / "in", "a.txt", lines("x/python"))
    raw = read_event_stream(spark, "text", str(tmp_path / "in"))
    query = S.start(event_stream(raw, DICTIONARY), "bounded", str(tmp_path / "c"), trigger="1 second",
                    path=str(tmp_path / "out"))
    assert S.run_stream(query, 6 / 60) is False
    assert not query.isActive
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1


def test_producer_and_consumer_together(spark, tmp_path):
    land(tmp_path / "in", "a.txt", lines("x/python", "none/none") + ["", "{broken"])
    raw = read_event_stream(spark, "text", str(tmp_path / "in"))
    table = S.run_streaming(spark, raw, DICTIONARY, str(tmp_path / "root"), trigger="1 second", minutes=15 / 60)
    assert [(r["keyword"], r["mentions"]) for r in stored(spark, table).collect()] == [("python", 1)]


def test_a_second_run_resumes(spark, tmp_path):
    counts = lambda: {(r["keyword"], r["mentions"]) for r in stored(spark, table).groupBy("keyword").agg(F.sum("mentions").alias("mentions")).collect()}
    (tmp_path / "in").mkdir()
    raw = read_event_stream(spark, "text", str(tmp_path / "in"))
    for name, repo in (("a.txt", "x/python"), ("b.txt", "y/go"), ("c.txt", "z/python")):
        land(tmp_path / "in", name, lines(repo))
        table = S.run_streaming(spark, raw, DICTIONARY, str(tmp_path / "root"), trigger=None)
    assert counts() == {("python", 2), ("go", 1)}
    S.run_streaming(spark, raw, DICTIONARY, str(tmp_path / "root"), trigger=None, fresh=True)
    assert counts() == {("python", 4), ("go", 2)}  # a fresh start reads its source from the beginning, and only its own topic
    S.run_streaming(spark, raw, DICTIONARY, str(tmp_path / "root"), trigger=None)
    assert counts() == {("python", 4), ("go", 2)}


def test_producer_errors_are_raised(spark, tmp_path):
    land(tmp_path / "in", "a.txt", lines("x/python"))
    broken = read_event_stream(spark, "text", str(tmp_path / "in")).withColumn("value", F.raise_error(F.lit("no such event")).cast("string"))
    with pytest.raises(Exception, match="no such event"):
        S.run_streaming(spark, broken, DICTIONARY, str(tmp_path / "root"), trigger="1 second", minutes=20 / 60)


def test_late_events_and_duplicates(spark, tmp_path):
    base = datetime(2024, 1, 1, 12)
    schema = "event_id string, event_timestamp timestamp, keyword string"

    def drop(name, rows):
        spark.createDataFrame([(i, base + timedelta(seconds=s), "go") for i, s in rows], schema).coalesce(1).write.mode(
            "append").parquet(str(tmp_path / "in" / name))

    source = (spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(str(tmp_path / "in"))
              if (tmp_path / "in").mkdir() is None else None)
    out = windowed_trends(dedupe_events(source, lateness="10 seconds"), "30 seconds", "30 seconds", lateness="10 seconds")

    def run():
        query = S.start(out, "late", str(tmp_path / "c"), path=str(tmp_path / "out"), trigger=None)
        S.run_stream(query, None)

    drop("1", [("a", 0), ("a", 1), ("b", 5)])
    run()
    drop("2", [("c", 100), ("d", 101)])
    run()
    drop("3", [("late", 3), ("e", 200)])
    run()
    got = {(r["window_start"], r["mentions"]) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {(base, 2), (base + timedelta(seconds=90), 2)}


def test_live_options():
    assert KAFKA_OPTIONS == {"startingOffsets": "latest", "failOnDataLoss": "false", "maxOffsetsPerTrigger": "100"}


def test_checkpoint_paths(spark, tmp_path):
    root = str(tmp_path)
    assert S.checkpoint_path(spark, "q", root) == f"{root}/checkpoint-q"
    assert S.checkpoint_path(spark, "q", root, fresh=True) != S.checkpoint_path(spark, "q", root, fresh=True)


def test_pandas_version_agrees(spark):
    """The native repository match against a plain Python statement of the rule."""
    import pandas as pd

    keywords = ["python", "go", "javascript", "rust"]
    longest = sorted(keywords, key=len, reverse=True)

    @F.pandas_udf("array<string>")
    def plain(names: pd.Series) -> pd.Series:
        def one(name):
            low = name.lower()
            for sep in "/-._":
                low = low.replace(sep, " ")
            exact = sorted(set(low.split()) & set(keywords))
            return exact or [k for k in longest if k in name.lower()][:1]
        return names.map(one)

    from mentionflow.functions.text import repo_hits

    dictionary = Dictionary.of([(k, "language") for k in keywords])
    names = [f"{a}{s}{b}" for a in ("My", "go", "rusty", "python") for s in "/-_. " for b in ("python", "javascripts", "x", "Rust")]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    assert df.where(repo_hits(F.col("n"), dictionary) != plain("n")).count() == 0


def test_panes_make_the_same_windows(spark):
    from pyspark.sql import functions as F

    rows = [(f"2024-01-01 00:00:{s % 60:02d}.{s % 7}", k) for s in range(0, 50, 3) for k in ("a", "b") for _ in range(s % 4)]
    df = spark.createDataFrame(rows, "event_timestamp string, keyword string").withColumn("event_timestamp", F.col("event_timestamp").cast("timestamp"))
    direct = (df.groupBy(F.window("event_timestamp", "30 seconds", "3 seconds"), "keyword").agg(F.count("*").alias("mentions"))
              .select("window.start", "window.end", "keyword", "mentions"))
    assert sorted(map(tuple, windowed_trends(df).collect())) == sorted(map(tuple, direct.collect()))
    with pytest.raises(ValueError):
        windowed_trends(df, "30 seconds", "7 seconds")
    assert windowed_trends(df, "30 seconds", None).count() == df.groupBy(F.window("event_timestamp", "30 seconds"), "keyword").count().count()


def test_state_holds_panes_and_windows_not_rows(spark, tmp_path):
    """Ten times the events of the same seconds leave the same number of state rows."""
    from pyspark.sql import functions as F

    def state_rows(times):
        source = str(tmp_path / f"in-{times}")
        spark.range(60 * times).select((F.lit(1704067200) + F.col("id") % 60).cast("timestamp").alias("event_timestamp"), F.lit("go").alias("keyword")).write.parquet(source)
        stream = spark.readStream.schema("event_timestamp timestamp, keyword string").parquet(source)
        query = (windowed_trends(stream, lateness="10 minutes").writeStream.format("noop").outputMode("append")
                 .option("checkpointLocation", str(tmp_path / f"check-{times}")).trigger(availableNow=True).start())
        query.awaitTermination()
        return [s["numRowsTotal"] for s in query.lastProgress["stateOperators"]]

    few, many = state_rows(1), state_rows(10)
    assert few == many and max(many) <= 60


def test_micro_batches_of_a_table_have_its_splits(spark, sf_dir, tmp_path):
    """A longer table makes more files in each of the micro-batches, not longer files."""
    from mentionflow.checks import streams

    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(40 * 1024))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        rows = spark.read.parquet(f"{sf_dir}/documents.parquet")
        splits, total = rows.rdd.getNumPartitions(), rows.count()
        assert splits > streams.BATCHES
        stream = streams._stream(spark, sf_dir, "documents")
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    seen = []

    def note(batch, epoch):
        files = batch.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count("*").alias("rows")).collect()
        seen.append([r["rows"] for r in files])

    S.run_stream(S.start(stream.select("doc_id", "_metadata"), "splits", str(tmp_path / "c"), each_batch=note, trigger=None), None)
    assert len(seen) == streams.BATCHES and sum(map(sum, seen)) == total
    assert all(len(files) == splits for files in seen)
    assert max(map(max, seen)) < total / streams.BATCHES / 2
