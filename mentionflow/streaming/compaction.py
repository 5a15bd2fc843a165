"""Compaction of the live mention table: many batch folders of a run become one.

The batch that a stream may still replay is its newest one, so all others can be merged.
The merged folder names the last batch it holds (``batch_id=upto_41``), which is its
manifest: a batch up to that number is not written again. Rows keep the batch they came from
in ``source_batch``. The merged rows are put in place and the batch folders taken away by
one journaled change, so a driver that dies leaves either the old folders or the new one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..schemas import BRONZE_STREAM
from ..sources import tables
from ..sources.journal import Journal

BATCH, MERGED = "batch_id=batch_", "batch_id=upto_"
#: The stored table: the fixed columns, the run, and the batch of a merged row.
STORED = StructType([*BRONZE_STREAM.fields, StructField("run", StringType()), StructField("source_batch", StringType())])
PARTITIONS = ["run", "batch_id", "date", "hour"]


def _numbers(names: list[str], prefix: str) -> list[int]:
    return sorted(int(name[len(prefix):]) for name in names if name.startswith(prefix))


def merged_upto(spark: SparkSession, path: str, run: str) -> int:
    """Number of the last batch of a run that a merged folder holds; -1 if none does."""
    return max(_numbers(Journal(spark, path).names(f"run={run}"), MERGED), default=-1)


def read_stream_table(spark: SparkSession, path: str) -> DataFrame:
    """The live table with each row's own batch, merged or not, and its run."""
    rows = tables.read_table(spark, path, STORED)
    return rows.withColumn("batch_id", F.coalesce("source_batch", "batch_id")).drop("source_batch")


def compact(spark: SparkSession, path: str, run: str = "default", replayable: int = 1) -> dict:
    """Merge all batches of a run but the newest ``replayable`` ones, and what was merged before.

    The driver sees folder names; rows are gathered by hour, a large hour in several files.
    """
    journal = Journal(spark, path)
    journal.recover()
    names = journal.names(f"run={run}")
    batches = _numbers(names, BATCH)
    due = batches[:len(batches) - replayable] if replayable else batches
    if not due:
        return {"merged": 0, "upto": max(_numbers(names, MERGED), default=-1)}
    folders = [f"{BATCH}{n}" for n in due] + [f"{MERGED}{n}" for n in _numbers(names, MERGED)]
    last = f"upto_{due[-1]}"
    stored = tables.read_table(spark, path, STORED).where(F.col("run") == run).where(F.col("batch_id").isin([f.split("=", 1)[1] for f in folders]))
    rows = stored.withColumn("source_batch", F.coalesce("source_batch", "batch_id")).withColumn("batch_id", F.lit(last))
    staged = journal.begin()
    rows.hint("rebalance", "date", "hour").write.partitionBy(*PARTITIONS).parquet(staged)
    journal.publish(staged, journal.folders(staged, len(PARTITIONS)), [f"run={run}/{folder}" for folder in folders])
    return {"merged": len(due), "upto": due[-1]}
