"""Trailing windows from mergeable partials."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from mentionflow.plans import daily
from mentionflow.plans.partials import DAY, MONTH, date_span, day_partials, month_partials, trailing_totals
from mentionflow.plans.trends import trend_rows, window_rows
from mentionflow.schemas import GOLD, PARTIALS, TIMEFRAMES, conform
from mentionflow.sources import tables as T


def gold_rows(spark, first="2023-10-20", days=140, seed=3):
    rng = random.Random(seed)
    rows = [((date.fromisoformat(first) + timedelta(d)).isoformat(), f"t{k}", f"c{k % 2}", rng.randint(0, 2000))
            for d in range(days) for k in range(6) if rng.random() < 0.5]
    rows += [(None, "t0", "c0", 5), ("2024-01-02", None, "c0", 5), ("2024-01-02", "t1", "c1", 7)]
    return spark.createDataFrame(rows, "date string, technology string, technology_category string, daily_mentions long")


@pytest.mark.parametrize("as_of", ["2024-03-07", "2024-02-29", "2023-10-31", "2023-10-20", "2023-10-01"])
def test_windows_from_partials_are_those_of_gold(spark, as_of):
    gold = gold_rows(spark)
    days = day_partials(gold)
    months = ["2023-10-01", "2023-11-01", "2023-12-01", "2024-01-01", "2024-02-01"]
    partials = days.unionByName(month_partials(days.where(F.concat(F.substring("date", 1, 7), F.lit("-01")).isin(months))))
    totals = trailing_totals(partials, as_of, months)
    span = tuple(date_span(partials, as_of).first())
    for timeframe in TIMEFRAMES:
        columns = ["technology", "technology_category", "total_mentions", "avg_daily_mentions", "peak_day_mentions", "days_with_activity", "start_date", "end_date", "days"]
        direct = trend_rows(gold.where("date IS NOT NULL"), as_of, timeframe).select(*columns)
        assert sorted(map(tuple, window_rows(totals, as_of, timeframe, span).select(*columns).collect())) == sorted(map(tuple, direct.collect()))


def test_a_new_day_reads_one_day_of_gold(spark, tmp_path, monkeypatch):
    layout = daily.Layout(str(tmp_path))
    full = conform(gold_rows(spark, days=60).where("date <= '2023-12-18' AND technology IS NOT NULL").withColumns(
        {c: F.lit(None).cast("string") for c in GOLD.fieldNames() if c not in ("date", "technology", "technology_category", "daily_mentions")}), GOLD)
    daily.create_tables(spark, layout)
    last = "2023-12-18"
    T.replace_partitions(full.where(F.col("date") < last), layout.gold, ["date"])
    assert daily.run_trends(spark, layout)["status"] == "success"
    read = []
    real = daily._dates
    monkeypatch.setattr(daily, "_dates", lambda df, dates: (read.append(list(dates)), real(df, dates))[1])
    T.replace_partitions(full.where(F.col("date") == last), layout.gold, ["date"])
    assert daily.run_trends(spark, layout)["status"] == "success"
    assert read == [[last]]
    stored = T.read_table(spark, layout.partials, PARTIALS)
    assert sorted(map(tuple, stored.where(F.col("span") == DAY).drop("span").collect())) == sorted(map(tuple, day_partials(full).drop("span").collect()))
    assert {r["date"] for r in stored.where(F.col("span") == MONTH).select("date").distinct().collect()} == {"2023-10-01", "2023-11-01"}


def test_a_rewritten_day_mends_its_month(spark, tmp_path):
    layout = daily.Layout(str(tmp_path))
    row = lambda d, n: (d, "go", n, n, n, "language", "low", "complete", None, "x", None)
    columns = ["date", "technology", "daily_mentions", "daily_repo_mentions", "daily_event_mentions", "technology_category", "mention_volume", "data_completeness", "processed_at", "data_source", "primary_repository"]
    make = lambda rows: conform(spark.createDataFrame(rows, ", ".join(f"{c} {GOLD[c].dataType.simpleString()}" for c in columns)), GOLD)
    daily.create_tables(spark, layout)
    T.replace_partitions(make([row("2024-01-05", 1), row("2024-01-06", 2), row("2024-02-01", 4)]), layout.gold, ["date"])
    daily.refresh_partials(spark, layout, ["2024-01-05", "2024-01-06", "2024-02-01"])
    T.replace_partitions(make([row("2024-01-05", 100)]), layout.gold, ["date"])
    daily.refresh_partials(spark, layout, ["2024-01-05"])
    stored = T.read_table(spark, layout.partials, PARTIALS).where(F.col("span") == MONTH).collect()
    assert [(r["date"], r["mentions"], r["peak"], r["active"]) for r in stored] == [("2024-01-01", 102, 100, 2)]
    T.replace_partitions(make([]), layout.gold, ["date"], [{"date": "2024-02-01"}])
    daily.refresh_partials(spark, layout, ["2024-02-01"])
    stored = T.read_table(spark, layout.partials, PARTIALS).collect()
    assert {(r["span"], r["date"]) for r in stored} == {(DAY, "2024-01-05"), (DAY, "2024-01-06")}  # no later month: January is open again
