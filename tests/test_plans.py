"""Properties of physical plans that decide whether a query survives large tables."""

import io
import re
from contextlib import redirect_stdout

import pytest

from mentionflow import checks
from mentionflow.checks import inputs as I
from mentionflow.operators import matching as M
from pyspark.sql import functions as F

QUERIES = checks.queries()
# queries that run streams or write tables are slow to plan; their parts are covered by the others
STORED = re.compile(r"^(s(1|2|4|5|6|8|9|10|13|14|18)_|x|f4_|g8_|g9_|g10_)")


def plan_of(df) -> str:
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not STORED.match(n)))
def test_no_pairwise_join_and_no_python(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert bad not in plan, bad


def test_matching_does_not_shuffle(spark, sf_dir):
    docs = I.doc_events(spark, sf_dir)
    assert "Exchange" not in plan_of(M.match_events(M.relevant_events(docs), I.TEXT_DICTIONARY))
    assert "Exchange" not in plan_of(M.match_any(M.searchable(docs), "searchable_text", I.TEXT_DICTIONARY))
    assert "Exchange" not in plan_of(M.match_repo(docs.select("repo.name"), "name", I.TEXT_DICTIONARY))


def test_keyword_probe_is_a_hash_set(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert "INSET" in plan_of(M.match_words(docs, "text", I.TEXT_DICTIONARY, ["doc_id"]))


def test_columns_and_filters_reach_the_scan(spark, sf_dir):
    plan = plan_of(QUERIES["a20_range_stats"](spark, sf_dir))
    assert "ReadSchema: struct<event_id:bigint,event_type:string>" in plan
    assert "EqualTo(event_type,click)" in plan


def test_partition_condition_prunes_folders(spark, sf_dir, tmp_path):
    from mentionflow.plans.trends import trend_rows
    from mentionflow.schemas import GOLD
    from mentionflow.sources import tables

    path = str(tmp_path / "gold")
    tables.replace_partitions(I.gold(spark, sf_dir), path, ["date"])
    plan = plan_of(trend_rows(tables.read_table(spark, path, GOLD), "2024-01-30", "7d"))
    assert re.search(r"PartitionFilters: \[.*2024-01-24", plan)


def test_classification_does_not_shuffle(spark, sf_dir, tmp_path):
    from mentionflow.plans.gold import build_gold

    path = str(tmp_path / "silver")
    I.silver(spark, sf_dir).write.parquet(path)
    plan = plan_of(build_gold(spark.read.parquet(path), I.EVENT_DICTIONARY))
    assert "Exchange hashpartitioning" not in plan and "BroadcastHashJoin" in plan


def test_bronze_aggregates_before_it_moves(spark, sf_dir):
    plan = plan_of(I.bronze(spark, sf_dir))
    assert "partial_count" in plan
    # (date, hour, keyword, repo), (date, hour, keyword), (date, hour)
    assert len(set(re.findall(r"hashpartitioning\(([^)]*)\)", plan))) == 3
    assert "SinglePartition" not in plan
