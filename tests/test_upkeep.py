"""Compaction of the live table, stored bitmaps, and files that single values are looked up in."""

import os

import pytest
from pyspark.sql import functions as F

from mentionflow.operators import distinct
from mentionflow.sources import journal as J, tables as T
from mentionflow.streaming.compaction import STORED, compact, merged_upto, read_stream_table
from mentionflow.streaming.sink import write_batch

NOW = "2024-03-01 10:20:00"


class Died(BaseException):
    pass


def batch(spark, *repos):
    return spark.createDataFrame([(str(k), r, ["go", "rust"][: 1 + k % 2]) for k, r in enumerate(repos)], "event_id string, repo_name string, technologies array<string>")


def counts(spark, path):
    return sorted((r.batch_id, r.run, r.keyword, r.top_repo, r.mentions) for r in read_stream_table(spark, path).collect())


@pytest.fixture
def live(spark, tmp_path):
    path = str(tmp_path / "live")
    write = write_batch(path, now=F.lit(NOW).cast("timestamp"))
    for epoch in range(5):
        write(batch(spark, "a/b", f"x/{epoch}"), epoch)
    write_batch(path, run="other", now=F.lit(NOW).cast("timestamp"))(batch(spark, "o/o"), 0)
    return path, write


def test_compaction_keeps_all_rows_and_replays_count_once(spark, live):
    path, write = live
    before = counts(spark, path)
    assert compact(spark, path) == {"merged": 4, "upto": 3} and merged_upto(spark, path, "default") == 3
    assert counts(spark, path) == before
    assert sorted(os.listdir(f"{path}/run=default")) == ["batch_id=batch_4", "batch_id=upto_3"]
    for epoch in range(5):
        write(batch(spark, "a/b", f"x/{epoch}"), epoch)
    assert counts(spark, path) == before
    write(batch(spark, "new/er"), 5)
    assert compact(spark, path) == {"merged": 1, "upto": 4}
    assert [c for c in counts(spark, path) if c[0] != "batch_5"] == before and merged_upto(spark, path, "other") == -1
    assert compact(spark, path) == {"merged": 0, "upto": 4}
    assert len(os.listdir(f"{path}/run=default/batch_id=upto_4/date=2024-03-01/hour=10")) <= 4


@pytest.mark.parametrize("moves", range(0, 7))
def test_a_compaction_that_dies_loses_and_doubles_nothing(spark, live, monkeypatch, moves):
    path, write = live
    before, left, real = counts(spark, path), [moves], J.Journal._move

    def move(self, *args):
        if left[0] == 0:
            raise Died()
        left[0] -= 1
        return real(self, *args)

    with monkeypatch.context() as patch:
        patch.setattr(J.Journal, "_move", move)
        try:
            compact(spark, path)
        except Died:
            pass
    T.recover(spark, path)
    assert counts(spark, path) == before
    compact(spark, path)
    assert counts(spark, path) == before


def test_stored_schema_has_the_fixed_columns_first():
    assert STORED.fieldNames()[-2:] == ["run", "source_batch"] and len(STORED) == 20


def test_bitmaps_count_exactly_and_merge(spark):
    values = [(d, v) for d, vs in (("d1", [1, 1, 0, -1, None, 40_000]), ("d2", [1, 2, -40_000, 2 ** 40]), ("d3", [None])) for v in vs]
    df = spark.createDataFrame(values, "date string, n long")
    bitmaps = distinct.number_bitmaps(df, ["n"], "date")
    assert sorted((r.date, r.distinct_values) for r in distinct.distinct_counts(bitmaps, "date").collect()) == [("d1", 4), ("d2", 4)]
    assert [r.distinct_values for r in distinct.distinct_counts(bitmaps).collect()] == [7]
    assert distinct.distinct_counts(distinct.number_bitmaps(df.limit(0), ["n"], "date")).isEmpty()


def test_a_new_date_is_added_without_the_others(spark, tmp_path):
    path = str(tmp_path / "bitmaps")
    day = lambda d, low, high: spark.range(low, high).select(F.lit(d).alias("date"), F.col("id").alias("n"))
    for d, low, high in (("2024-01-01", 0, 50_000), ("2024-01-02", 40_000, 90_000)):
        T.replace_partitions(distinct.number_bitmaps(day(d, low, high), ["n"], "date"), path, ["date"])
    stored = T.read_table(spark, path)
    assert distinct.distinct_counts(stored).first().distinct_values == 90_000
    assert distinct.distinct_counts(stored, "date").agg(F.sum("distinct_values")).first()[0] == 100_000


def scanned_rows(df):
    """Rows that the scan of a plan has put out."""
    plan = df._jdf.queryExecution().executedPlan()
    plan.executeCollect()
    leaves = plan.collectLeaves()
    return sum(leaves.apply(k).metrics().apply("numOutputRows").value() for k in range(leaves.size()))


def test_a_single_keyword_skips_row_groups(spark, tmp_path):
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("parquet.block.size", "65536")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rows = spark.range(60_000).select(F.lit("2024-01-01").alias("date"), F.concat(F.lit("t"), F.pmod(F.col("id") * 7919, F.lit(20_000)).cast("string")).alias("k"), F.col("id").alias("v"))
        plain, sorted_ = str(tmp_path / "plain"), str(tmp_path / "sorted")
        T.replace_partitions(rows, plain, ["date"])
        T.replace_partitions(rows, sorted_, ["date"], lookup=["k"])
        ask = lambda path, key: T.read_table(spark, path, rows.schema).where(F.col("k") == key)
        assert sorted(map(tuple, ask(plain, "t77").collect())) == sorted(map(tuple, ask(sorted_, "t77").collect()))
        assert scanned_rows(ask(sorted_, "t77")) < 0.3 * 60_000 and scanned_rows(ask(plain, "t77")) > 0.9 * 60_000
        assert scanned_rows(ask(sorted_, "t77x")) == 0  # between others, but its filter says no
    finally:
        conf.unset("parquet.block.size")
        spark.conf.unset("spark.sql.adaptive.enabled")
