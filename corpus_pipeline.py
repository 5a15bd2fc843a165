"""A corpus pipeline: toxic texts go, one of each group of near copies stays, benchmark text goes, sources are mixed.

Every stage takes (spark, docs, sf_dir) and works on all that the stage before kept; its
result is written as Parquet and read again as the next one's documents. Rows without id
pass the filters, as no decision can name them; NULL and empty texts are documents too.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from mentionflow.llm import decontaminate, mixing, ngram_join, toxicity
from mentionflow.llm.common import boxed, table, unboxed
from mentionflow.llm.queries import MIX_WEIGHTS, toxicity_model
from mentionflow.session import materialize


#: Near copies: five words to a shingle, similarity of 0.8.
SIMILAR = ngram_join.Rule(5, 80, 100)


def _without(docs: DataFrame, ids: DataFrame, name: str) -> DataFrame:
    """Documents but those of the given ids."""
    ids = materialize(ids.distinct(), name).select(F.struct("doc_id").alias("_dropped"))
    return unboxed(boxed(docs, _id=F.col("doc_id")).join(ids, F.col("_id") == F.col("_dropped.doc_id"), "left_anti"), docs.columns, {})


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not reject."""
    model = toxicity_model(docs, table(spark, sf_dir, "labels"))
    return docs.where(model.score(F.col("text")) < 0.5)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each component of similar texts; one row of repeated ids."""
    found = materialize(ngram_join.near_duplicates(docs.select("doc_id", "text"), rule=SIMILAR).select("doc_id", "component_id"), "near-duplicates")
    kept = _without(docs, found.where("doc_id <> component_id").select("doc_id"), "dropped")
    repeated = materialize(found.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count("*").alias("rows")).where("rows > 1").select("doc_id"), "repeated")
    if repeated.isEmpty():
        return kept
    once = kept.join(repeated, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return _without(kept, repeated, "repeated").unionByName(once.select(kept.columns))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item."""
    hits = decontaminate.phrase_hits(docs.select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return _without(docs, hits.select("doc_id"), "contaminated")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix takes, with ``size``, ``source_size``, ``target`` and ``taken``."""
    return mixing.mix(docs, mixing.word_count(F.col("text")), MIX_WEIGHTS).where("taken > 0")


STAGES = [("toxicity", drop_toxic), ("near_duplicates", drop_near_duplicates),
          ("decontamination", drop_contaminated), ("mixing", mix_sources)]

#: The toxicity model has no SQL form; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
