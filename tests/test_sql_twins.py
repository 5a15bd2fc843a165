"""Every registered query against its SQL on the same tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as driver
from compare import compare, connect

QUERIES, SQL = driver.queries(), driver.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(SQL))
def test_agrees_with_sql(spark, sf_dir, duck, name):
    assert compare(duck, QUERIES[name](spark, sf_dir), SQL[name]) == []


def test_sample_has_rows(spark, sf_dir):
    drawn = QUERIES["o5_sample"](spark, sf_dir).count()
    total = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    assert 0 < drawn < total


def test_every_query_of_the_library_itself_has_sql():
    from mentionflow import checks

    assert set(checks.queries()) == set(checks.oracle_sql())


def test_entry(spark):
    df = driver.entry(spark)
    assert df.count() > 0
    assert df.columns[:3] == ["analysis_date", "window_start_date", "window_end_date"]
