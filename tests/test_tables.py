import pytest
from pyspark.sql import functions as F

from mentionflow.plans import daily
from mentionflow.plans.bronze import build_bronze
from mentionflow.checks import inputs as I
from mentionflow.schemas import BRONZE, BRONZE_STREAM, GOLD, SILVER, TIMEFRAMES, conform, trend_schema
from mentionflow.session import scratch_path
from mentionflow.sources import tables as T
from mentionflow.sources.events import parse_events, read_events, read_hourly, read_name_list

SCHEMA = "date string, k string, v long"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def rows_of(spark, path):
    schema = frame(spark, []).schema
    return sorted(tuple(r) for r in T.read_table(spark, path, schema).collect())


def test_replace_keeps_other_partitions_and_string_dates(spark, tmp_path):
    path = str(tmp_path / "t")
    T.replace_partitions(frame(spark, [("2024-01-01", "a", 1), ("2024-01-02", "a", 1)]), path, ["date"])
    T.replace_partitions(frame(spark, [("2024-01-02", "b", 2)]), path, ["date"])
    T.replace_partitions(frame(spark, [("2024-01-02", "b", 2)]), path, ["date"])
    assert rows_of(spark, path) == [("2024-01-01", "a", 1), ("2024-01-02", "b", 2)]
    assert T.read_table(spark, path, frame(spark, []).schema).schema["date"].dataType.simpleString() == "string"
    T.replace_partitions(frame(spark, []), path, ["date"], [{"date": "2024-01-01"}])
    assert rows_of(spark, path) == [("2024-01-02", "b", 2)]


def test_create_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "t")
    assert T.create_if_absent(spark, path, SILVER, ["date"])
    assert not T.create_if_absent(spark, path, SILVER, ["date"])
    assert T.read_table(spark, path, SILVER).count() == 0


def test_delete_reports_and_keeps_unknown(spark, tmp_path):
    path = str(tmp_path / "t")
    T.append_table(frame(spark, [("2024-01-01", "a", 1), ("2024-01-02", "a", 5), ("2024-01-02", "b", None), ("2024-01-02", "c", 1)]),
                   path, ["date"])
    found = T.delete_where(spark, path, frame(spark, []).schema, F.col("v") < 3, ["date"])
    assert found == {"removed": 2, "remaining": 2}
    assert rows_of(spark, path) == [("2024-01-02", "a", 5), ("2024-01-02", "b", None)]


def test_rollback_restores_the_partition(spark, tmp_path):
    path, schema = str(tmp_path / "t"), frame(spark, []).schema
    T.append_table(frame(spark, [("2024-01-01", "a", 1), ("2024-01-02", "a", 2)]), path, ["date"])

    def fail(date):
        def work():
            T.replace_partitions(frame(spark, [(date, "x", 9)]), path, ["date"])
            raise RuntimeError("boom")
        return work

    assert T.with_rollback(spark, path, schema, {"date": "2024-01-02"}, fail("2024-01-02"))["status"] == "failed"
    assert T.with_rollback(spark, path, schema, {"date": "2024-01-03"}, fail("2024-01-03"))["backed_up"] == 0
    assert rows_of(spark, path) == [("2024-01-01", "a", 1), ("2024-01-02", "a", 2)]
    done = T.with_rollback(spark, path, schema, {"date": "2024-01-02"}, lambda: None)
    assert done == {"status": "success", "backed_up": 1}


def test_verify_and_partition_read(spark, tmp_path):
    path = str(tmp_path / "t")
    T.append_table(frame(spark, [("2024-01-01", "a", 1), ("2024-01-02", "a", 2)]), path, ["date"])
    table = T.read_table(spark, path, frame(spark, []).schema)
    assert tuple(T.verify_write(table, "2024-01-02").first()) == (1, 2)
    assert T.read_table(spark, path, frame(spark, []).schema, date="2024-01-02").count() == 1


def test_table_names():
    assert T.table_path("s/", "gold", "x") == "s/gold/gold_github_x"


def test_catalog_table(spark):
    stored = T.save_as_table(spark.range(5).toDF("n"), "mention_checks", "numbers")
    assert stored.count() == 5
    spark.sql("DROP TABLE mention_checks.numbers")
    spark.sql("DROP DATABASE mention_checks")


def test_bad_event_lines(spark, tmp_path):
    import gzip

    good = '{"id":"1","type":"PushEvent","repo":{"name":"a/b"},"payload":{"commits":[{"message":"go"}]}}'
    with gzip.open(tmp_path / "2024-01-05-7.json.gz", "wt") as f:
        f.write("\n".join([good, "", "   ", "{broken", '{"id":"2","type":"PushEvent","payload":null}', "[1]"]))
    events = read_events(spark, str(tmp_path)).orderBy("id").collect()
    kept = [(r["id"], r["date"], r["hour"]) for r in events if r["id"]]
    assert kept == [("1", "2024-01-05", 7), ("2", "2024-01-05", 7)]
    facts = build_bronze(read_events(spark, str(tmp_path)), I.Dictionary.of([("go", "language")])).collect()
    assert [(r["keyword"], r["mentions"], r["hour"]) for r in facts] == [("go", 1, 7)]


def test_hourly_files_and_names(spark, tmp_path):
    for hour in (0, 5):
        spark.createDataFrame([(hour, "go")], "hour int, keyword string").write.parquet(
            str(tmp_path / f"keywords-2024-01-01-hour-{hour:02d}.parquet"))
    spark.createDataFrame([(9, "no")], "hour int, keyword string").write.parquet(
        str(tmp_path / "keywords-2024-01-02-hour-09.parquet"))
    assert sorted(r[0] for r in read_hourly(spark, str(tmp_path), "2024-01-01").collect()) == [0, 5]
    (tmp_path / "names.json").write_text('["b", "a"]')
    assert [r["name"] for r in read_name_list(spark, str(tmp_path / "names.json")).orderBy("ordinal").collect()] == ["b", "a"]


def test_scratch_lies_in_the_folder_of_the_session(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    first = scratch_path(spark, "x")
    assert first.startswith(f"{folder}/x-") and first != scratch_path(spark, "x")


def test_no_scratch_on_the_drivers_own_disk():
    class Cluster:
        class sparkContext:
            master = "spark://somewhere:7077"

        class conf:
            get = staticmethod(lambda key, default=None: {"spark.sql.warehouse.dir": "file:/home/me/warehouse"}.get(key, default))

    with pytest.raises(ValueError):
        scratch_path(Cluster, "x")


@pytest.fixture(scope="module")
def built(spark, sf_dir, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("daily"))
    layout = daily.Layout(root)
    daily.write_bronze(I.bronze(spark, sf_dir), layout)
    return root, layout, daily.run_daily(spark, root, I.EVENT_DICTIONARY)


def test_daily_run(spark, built):
    root, layout, report = built
    assert report["silver"]["status"] == report["gold"]["status"] == report["trends"]["status"] == "success"
    assert [(r["layer"], r["missing_dates"], r["complete"]) for r in report["layers"]] == [
        ("bronze", 0, True), ("silver", 0, True), ("gold", 0, True)]
    assert report["layers"][1]["dates"] == 30
    assert report["strategy"] == "single_run_complete_pipeline" and report["silver"]["dates_skipped"] == []
    for timeframe in TIMEFRAMES:
        assert T.read_table(spark, layout.trends(timeframe), trend_schema(timeframe)).count() > 0


def test_daily_rerun_changes_nothing(spark, built):
    root, layout, _ = built

    def content():
        silver = T.read_table(spark, layout.silver, SILVER).drop("processed_at")
        gold = T.read_table(spark, layout.gold, GOLD).drop("processed_at")
        trends = T.read_table(spark, layout.trends("7d"), trend_schema("7d")).drop("processed_at")
        return [sorted(map(tuple, df.collect()), key=str) for df in (silver, gold, trends)]

    before = content()
    again = daily.run_daily(spark, root, I.EVENT_DICTIONARY)
    assert again["silver"]["status"] == "skipped" and again["gold"]["status"] == "skipped"
    assert again["trends"]["status"] == "success" and again["strategy"] == "single_run_analytics_only"
    assert content() == before
    manual = daily.run_daily(spark, root, I.EVENT_DICTIONARY, date="2024-01-10")
    assert manual["silver"]["dates_processed"] == ["2024-01-10"]
    assert content() == before


def test_daily_keys_are_unique_and_ranks_dense(spark, built):
    _, layout, _ = built
    for path, schema in ((layout.silver, SILVER), (layout.gold, GOLD)):
        df = T.read_table(spark, path, schema)
        assert df.groupBy("date", "technology").count().where("count > 1").count() == 0
    ranks = {r[0] for r in T.read_table(spark, layout.trends("30d"), trend_schema("30d")).select("mention_rank_30d").collect()}
    assert ranks == set(range(1, len(ranks) + 1))


def test_failed_timeframe_keeps_old_rows(spark, built, monkeypatch):
    root, layout, _ = built
    before = T.read_table(spark, layout.trends("30d"), trend_schema("30d")).count()
    real = daily.ranked_trends

    def broken(totals, date, timeframe, *rest):
        if timeframe == "30d":
            raise RuntimeError("no")
        return real(totals, date, timeframe, *rest)

    monkeypatch.setattr(daily, "ranked_trends", broken)
    report = daily.run_trends(spark, layout)
    assert report["status"] == "partial_success" and report["results"]["30d"]["status"] == "failed"
    assert T.read_table(spark, layout.trends("30d"), trend_schema("30d")).count() == before


def test_overall_status():
    ok, skip = {"status": "success"}, {"status": "skipped"}
    assert daily.overall_status({"a": ok, "b": ok}) == "success"
    assert daily.overall_status({"a": ok, "b": skip}) == "partial_success"
    assert daily.overall_status({"a": skip}) == "failed"


def test_too_few_records_fail_silver(spark, sf_dir, tmp_path):
    layout = daily.Layout(str(tmp_path))
    few = I.bronze(spark, sf_dir).limit(4).withColumn("date", F.lit("2024-01-01"))
    daily.write_bronze(few, layout)
    daily.create_tables(spark, layout)
    assert daily.run_silver(spark, layout, ["2024-01-01"])["status"] == "failed"


def test_bronze_schema(spark, sf_dir):
    assert [f.name for f in conform(I.bronze(spark, sf_dir), BRONZE).schema] == BRONZE.fieldNames()
    assert len(BRONZE_STREAM) == 18
