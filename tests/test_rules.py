import re

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import Window, functions as F

from mentionflow.functions import dates as D, rules as R
from mentionflow.operators import gaps, payloads, quality, ranking, rollups, versions
from mentionflow.plans.gold import build_gold, categorize
from mentionflow.plans.silver import build_silver
from mentionflow.plans.status import assess
from mentionflow.plans.trends import build_trends
from mentionflow.schemas import GOLD, SILVER, TIMEFRAMES, trend_schema
from mentionflow.sources.dictionary import Dictionary, category_groups, load_dictionary


def column(spark, values, kind, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("v"))).collect()]


def test_volume_tiers(spark):
    assert column(spark, [9, 10, 99, 100, 999, 1000], "long", R.mention_volume) == [
        "minimal", "low", "low", "medium", "medium", "high"]


def test_hotness(spark):
    assert column(spark, [49.9, 50.0, 199.9, 200.0], "double", R.hotness) == ["cool", "warm", "warm", "hot"]


def test_completeness(spark):
    assert column(spark, [0, 1], "long", R.completeness_flag) == ["empty", "complete"]
    assert column(spark, [1, 16], "long", lambda v: R.completeness_percent(v, F.lit(16))) == [6.2, 100.0]


@pytest.mark.parametrize("name,category", [
    ("docker", "language"), ("claude-4", "ai_model"), ("openai", "ai_platform"), ("langchain", "ai_framework"),
    ("pinecone", "vector_database"), ("uniswap", "blockchain_protocol"), ("hardhat", "blockchain_framework"),
    ("jest", "testing"), ("vite", "build_tool"), ("npm", "package_manager"), ("qt", "desktop_framework"),
    ("flask", "backend_framework"), ("vue", "web_framework"), ("tailwind", "ui_framework"),
    ("kafka", "data_engineering"), ("plotly", "data_visualization"), ("pandas", "data_analysis"),
    ("mysql", "database"), ("aws", "cloud_platform"), ("lambda", "cloud_service"), ("k8s", "devops"),
    ("git", "development_tool"), (" OpenAI ", "ai_platform"), ("expo", "mobile_framework"),
    ("ollama", "ai_model"), ("react", "language"), ("django", "language"), ("ethereum", "blockchain_platform")])
def test_inference(spark, name, category):
    assert column(spark, [name], "string", R.inferred_category) == [category]


def test_inference_is_ordered_substring_search(spark):
    """Against the plain statement of the rule."""
    names = [w + s for _, words in R.INFERENCE_RULES for w in words for s in ("", "-x")]

    def plain(name):
        return next((c for c, ws in R.INFERENCE_RULES if any(w in name for w in ws)), "development_tool")

    assert column(spark, names, "string", R.inferred_category) == [plain(n) for n in names]


def test_categories(spark):
    dictionary = Dictionary.of([("docker", "containerization"), ("odd", "no such type")])
    df = spark.createDataFrame([("docker",), ("odd",), ("Docker",), ("dockerx",)], "technology string")
    got = {r[0]: r[1] for r in categorize(df, dictionary).collect()}
    assert got == {"docker": "devops", "odd": "development_tool", "Docker": "devops", "dockerx": "language"}


def test_hierarchy_covers_every_inferred_category(spark):
    known = {r[0] for r in category_groups(spark).select("technology_category").distinct().collect()}
    assert {c for c, _ in R.INFERENCE_RULES} <= known


def bronze(spark, rows):
    return spark.createDataFrame(rows, "date string, hour int, keyword string, mentions long, top_repo string, "
                                       "repo_mentions long, event_mentions long")


def test_silver_score_is_clipped_and_nulls_leave(spark):
    rows = [("2024-01-01", i % 24, "go", 5, f"r{i}", 1, 9) for i in range(25)]
    rows += [("2024-01-01", 2, "rust", 1, None, 1, 9), ("2024-01-01", 3, "rust", 1, "z", 1, 9),
             ("2024-01-01", 1, None, 1, "z", 1, 9), (None, 1, "go", 1, "z", 1, 9)]
    got = {r["technology"]: r for r in build_silver(bronze(spark, rows)).collect()}
    assert set(got) == {"go", "rust"}
    assert got["go"]["data_quality_score"] == 100.0 and got["go"]["source_record_count"] == 25
    assert got["go"]["primary_repository"] == "r0"
    assert got["rust"]["primary_repository"] == "z" and got["rust"]["daily_mentions"] == 2
    assert got["rust"]["data_quality_score"] == pytest.approx(2 / 125 * 50 + 2 / 24 * 30 + 20)


def gold(spark, rows):
    return spark.createDataFrame(rows, "date string, technology string, technology_category string, "
                                       "daily_mentions long")


def test_trends_by_hand(spark):
    rows = [("2024-01-01", "old", "a", 1000), ("2024-01-24", "go", "a", 10), ("2024-01-30", "go", "a", 20),
            ("2024-01-30", "rust", "a", 30), ("2024-01-30", "lone", "b", 400), ("2024-01-30", "github", "b", 9999),
            ("2024-01-30", None, "b", 5)]
    got = {r["technology"]: r for r in build_trends(gold(spark, rows), "2024-01-30", "7d").collect()}
    assert set(got) == {"go", "rust", "lone"}
    assert (got["go"]["total_mentions_7d"], got["go"]["avg_daily_mentions_7d"], got["go"]["peak_day_mentions_7d"]) == (30, 15.0, 20)
    assert got["go"]["window_start_date"] == "2024-01-24" and got["go"]["data_completeness_7d"] == 28.6
    assert got["lone"]["mention_rank_7d"] == 1 and got["lone"]["category_rank_7d"] == 1
    assert got["go"]["mention_rank_7d"] == got["rust"]["mention_rank_7d"] == 2
    assert got["lone"]["hotness_signal_7d"] == "hot" and got["go"]["trend_direction_7d"] == "stable"
    everything = build_trends(gold(spark, rows), "2024-01-30", "alltime").collect()
    assert {(r["data_start_date"], r["total_days_analyzed"]) for r in everything} == {("2024-01-01", 3)}


@pytest.mark.parametrize("timeframe", list(TIMEFRAMES))
def test_trend_schemas(spark, timeframe):
    df = build_trends(gold(spark, [("2024-01-30", "go", "a", 1)]), "2024-01-30", timeframe)
    assert df.columns == trend_schema(timeframe).fieldNames()
    assert quality.validate(df, trend_schema(timeframe)).ok


def test_layers_fit_their_schemas(spark):
    silver = build_silver(bronze(spark, [("2024-01-01", 1, "go", 5, "r", 1, 9)]))
    assert quality.validate(silver, SILVER).ok
    assert quality.validate(build_gold(silver, load_dictionary(spark)), GOLD).ok


def test_validation_reports_everything(spark):
    df = spark.createDataFrame([("2024-01-01", None, 1.5)], "date string, technology string, daily_mentions double")
    found = quality.validate(df.withColumn("more", F.lit(1)), SILVER)
    assert not found.ok and "source_layer" in found.missing and found.extra == ["more"]
    assert found.wrong_type == {"daily_mentions": ("bigint", "double")} and found.nulls == {"technology": 1}
    with pytest.raises(ValueError):
        quality.require_valid(df, SILVER, "Silver")


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 2**45), st.sampled_from(["a", "b", None])), min_size=1, max_size=60))
def test_ranks_equal_one_window(spark, rows):
    df = spark.createDataFrame(rows, "v long, g string")
    got = ranking.add_dense_ranks(df, "v", {"o": [], "c": ["g"]})
    plain = (got.withColumn("o2", F.dense_rank().over(Window.orderBy(F.desc("v"))))
             .withColumn("c2", F.dense_rank().over(Window.partitionBy("g").orderBy(F.desc("v")))))
    assert plain.where("o != o2 OR c != c2").count() == 0 and plain.count() == len(rows)


def test_numbers_of_a_hot_group(spark):
    df = spark.range(3000).select((F.col("id") * 11).alias("v"), F.when(F.col("id") % 10 == 0, "b").otherwise("a").alias("g"))
    got = ranking.add_row_numbers(df, "v", ["g"], "n")
    wrong = got.withColumn("w", F.row_number().over(Window.partitionBy("g").orderBy("v"))).where("w != n")
    assert wrong.count() == 0 and got.count() == 3000


def test_value_ranges_follow_the_numbers(spark):
    values = sorted({0, 1, 2, 255, 256, 257, 511, 512, 513, 2**20, 2**20 + 5000, 2**40, 2**62} | set(range(0, 5000, 37)))
    ranges = column(spark, values, "long", ranking.value_range)
    assert ranges == sorted(ranges)


def test_file_dates(spark):
    assert [str(d) for d in column(spark, ["x/2024-02-29-7.json.gz", "2023-02-29.parquet", "none"], "string", D.file_date)] == [
        "2024-02-29", "None", "None"]


def test_unprocessed_dates(spark):
    rows = [("2024-01-01",)] * 6 + [("2024-01-02",)] * 5
    df = spark.createDataFrame(rows, "date string")
    got = sorted(r[0] for r in gaps.unprocessed_dates(df, "2024-01-01", "2024-01-05", ("2024-01-04", "2024-01-04")).collect())
    assert got == ["2024-01-02", "2024-01-03", "2024-01-05"]


def test_assessment(spark):
    def dates(*days):
        return spark.createDataFrame([(d,) for d in days], "date string")
    row = assess(dates("1", "2", "3"), dates("1", "2"), dates("1")).first()
    assert (row["silver_dates"], row["gold_dates"], row["strategy"]) == (["3"], ["2"], "single_run_complete_pipeline")
    row = assess(dates("1"), dates("1"), dates("1")).first()
    assert (row["strategy"], row["process_silver"], row["process_analytics"]) == ("single_run_analytics_only", False, True)
    row = assess(dates("1"), dates("1"), dates("1"), date="9").first()
    assert (row["mode"], row["silver_dates"], row["gold_dates"]) == ("manual", ["9"], ["9"])


def test_single_members_with_a_hot_group(spark):
    df = spark.createDataFrame([(i, "hot") for i in range(100)] + [(500, "lone"), (501, None)], "id int, g string")
    assert {tuple(r) for r in gaps.single_member_groups(df, "g").collect()} == {(500, "lone"), (501, None)}


def test_delete_keeps_unknown(spark):
    df = spark.createDataFrame([(1,), (None,), (3,)], "v int")
    assert [r[0] for r in versions.without(df, F.col("v") > 2).collect()] == [1, None]


def test_retention(spark):
    df = spark.createDataFrame([("2024-01-01", 9), ("2024-01-01", 10), ("2024-01-02", 0)], "date string, hour int")
    now = F.lit("2024-01-01 11:30:00").cast("timestamp")
    assert versions.retain_hours(df, now, 1).count() == 2
    assert tuple(versions.retention_report(df, now, 1).first()) == (1, 2)


def test_payload_ids_and_json(spark):
    from mentionflow.plans.ingest import payload_rows

    rows = [("s", "2024-01-01", 5, "t", "u5", 200, '{"b": [1, 2]}', "c"), ("s", "2024-01-01", 2, "t", "u2", 404, "x" * 600, "c"),
            ("s", "2024-01-01", 9, "t", "u9", None, "Request timeout", "c"), ("s", "2024-01-01", 10, "t", "u10", 200, "{bad", "c")]
    df = spark.createDataFrame(rows, "source_name string, collection_date string, arrival long, api_type string, url string, "
                                     "status_code int, body string, collected_at string")
    import json

    got = {r["record_id"]: json.loads(r["raw_response_json"]) for r in payload_rows(df, F.lit("now")).collect()}
    assert sorted(got) == [f"s_2024-01-01_{i:06d}" for i in range(4)]
    assert got["s_2024-01-01_000000"]["url"] == "u2" and len(got["s_2024-01-01_000000"]["error_text"]) == 600
    assert got["s_2024-01-01_000001"]["response_data"] == {"b": [1, 2]}
    assert got["s_2024-01-01_000002"]["status_code"] is None and got["s_2024-01-01_000002"]["error_text"] == "Request timeout"
    assert got["s_2024-01-01_000003"]["error_text"] == "Invalid JSON response"


def test_job_counts(spark):
    assert column(spark, ["[1,2,3]", "{}", None, "bad"], "string", payloads.payload_job_count) == [3, 0, 0, 0]


def test_thread_choice(spark):
    users = spark.createDataFrame([(1, list(range(100, 130)))], "user_id int, submitted array<int>")
    items = spark.createDataFrame(
        [(119, "story", "Who is hiring? (old)", [1]), (103, "story", "WHO IS HIRING now", [7, 8]),
         (101, "comment", "who is hiring", []), (110, "story", "Who is hiring?", [3])],
        "item_id int, type string, title string, kids array<int>").withColumn("text", F.col("title"))
    picked = payloads.pick_thread(users, items)
    assert [(r["pos"], r["item_id"]) for r in picked.collect()] == [(3, 103)]
    late = payloads.pick_thread(users, items.where("item_id = 119"))
    assert late.count() == 0
    comments = spark.createDataFrame([(8, "b"), (7, "a"), (9, "c")], "item_id int, text string")
    assert {tuple(r) for r in payloads.thread_comments(picked, comments).select("pos", "text").collect()} == {(0, "a"), (1, "b")}


def test_first_value_in_arrival_order(spark):
    df = spark.createDataFrame([("k", 3, "c"), ("k", 1, None), ("k", 2, "b"), ("k", 2, "a")], "k string, h int, v string")
    assert df.groupBy("k").agg(rollups.first_by("v", "h").alias("x")).first()["x"] == "a"


def test_range_stats_beyond_64_bits(spark):
    """The squares of numbers up to 6 * 10^6 sum to more than a long holds; short sums stay longs."""
    numbers = spark.range(1, 6_000_001).select("id", (F.col("id") % 2 == 0).alias("even"))
    n = 3_000_000
    out = rollups.as_long(rollups.range_stats(numbers, "id", F.col("even")), "total", "squares")
    assert tuple(out.first()) == (n, n * (n + 1), 6_000_000, 2 * n * (n + 1) * (2 * n + 1) // 3)
    assert 2 * n * (n + 1) * (2 * n + 1) // 3 > 2**63
    assert [t for _, t in out.dtypes] == ["bigint", "bigint", "bigint", "decimal(38,0)"]
    top = rollups.range_stats(spark.createDataFrame([(2**62,), (2**62 - 1,), (None,)], "id long"), "id", F.lit(True))
    assert tuple(top.first()) == (2, 2**63 - 1, 2**62, 2**124 + (2**62 - 1)**2)
    small = rollups.as_long(rollups.range_stats(numbers.limit(0), "id", F.col("even")), "total", "squares")
    assert tuple(small.first()) == (0, None, None, None) and dict(small.dtypes)["squares"] == "bigint"
    assert tuple(rollups.range_stats(numbers.select((F.col("id") / 4).alias("x")).limit(1), "x", F.lit(True)).first())[3] == 0.0625
