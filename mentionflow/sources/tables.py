"""Partitioned tables: read, append, replace partitions, delete, verify, roll back.

Tables are Parquet folders partitioned by a date-like column; ``fmt='delta'`` works for
reads and appends where a Delta package is on the classpath.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ..session import scratch_path
from .journal import Journal


def table_path(root: str, layer: str, name: str, domain: str = "github") -> str:
    """``{root}/{layer}/{layer}_{domain}_{name}``."""
    return f"{root.rstrip('/')}/{layer}/{layer}_{domain}_{name}"


def _nullable(schema: StructType) -> StructType:
    """Files carry no NOT NULL promise, so reads declare every field nullable."""
    out = StructType()
    for f in schema.fields:
        out = out.add(f.name, f.dataType, True)
    return out


def read_table(spark: SparkSession, path: str, schema: StructType | None = None,
               fmt: str = "parquet", **equals) -> DataFrame:
    """A table, or the partitions with the given column values.

    The schema keeps a string ``date`` partition a string (inference would make it a
    date). Conditions on partition columns prune folders.
    """
    reader = spark.read.format(fmt)
    if schema is not None and fmt != "delta":
        reader = reader.schema(_nullable(schema))
    df = reader.load(path)
    for column, value in equals.items():
        df = df.where(F.col(column) == value)
    return df if schema is None else df.select(*schema.fieldNames())


def table_exists(spark: SparkSession, path: str, fmt: str = "parquet") -> bool:
    """Existence of the folder; a table without rows exists too."""
    reader = spark.read.format(fmt)
    try:
        (reader if fmt == "delta" else reader.schema("_ int")).load(path)
        return True
    except AnalysisException:
        return False


def create_if_absent(spark: SparkSession, path: str, schema: StructType, partition_by: list[str],
                     fmt: str = "parquet") -> bool:
    """Create an empty typed table; an existing one is never touched."""
    if table_exists(spark, path, fmt):
        return False
    # no rows means no files: readers take the columns from the declared schema
    empty = spark.createDataFrame([], schema)
    empty.write.format(fmt).mode("append").partitionBy(*partition_by).save(path)
    return True


def append_table(df: DataFrame, path: str, partition_by: Iterable[str] = (), fmt: str = "parquet") -> None:
    df.write.format(fmt).mode("append").partitionBy(*partition_by).save(path)


def replace_partitions(df: DataFrame, path: str, partition_by: list[str],
                       emptied: Iterable[dict] = (), lookup: Iterable[str] = ()) -> None:
    """Write the partitions present in ``df``, replacing their old rows; others stay.

    A rerun gives the same table. Partitions that must end up empty are not in ``df``;
    name them in ``emptied`` as {column: value}. Rows are first gathered by partition, so
    each has few files; the rebalance hint lets AQE split a partition that is too large.

    The rows are written beside the table first; then a journal names the partitions to
    move, and they are moved. A driver that dies before the journal leaves the table as it
    was, one that dies later leaves a journal that the next write, or ``recover``, finishes.

    ``lookup`` names columns that readers ask for single values of: files are sorted by the
    first and carry Bloom filters for all of them, so a scan skips row groups without the value.
    """
    journal = Journal(df.sparkSession, path)
    journal.recover()
    spread = df.hint("rebalance", *[F.col(c) for c in partition_by])
    staged = journal.begin()
    lookup = list(lookup)
    if lookup:
        spread = spread.sortWithinPartitions(*partition_by, *lookup)
    blooms = {f"parquet.bloom.filter.enabled#{c}": "true" for c in lookup}
    spread.write.format("parquet").options(**blooms).partitionBy(*partition_by).save(staged)
    removed = [_partition_folder(df.sparkSession, values, partition_by) for values in emptied]
    journal.publish(staged, journal.folders(staged, len(partition_by)), removed)


def recover(spark: SparkSession, path: str) -> list[str]:
    """Finish or take back what a driver that died had begun on a table; says what was done.

    A table has one writer at a time; call it at the start of a run, before reading.
    """
    if not table_exists(spark, path):
        return []
    journal = Journal(spark, path)
    done = journal.recover()
    for entry in journal.open_rollbacks():
        _restore(spark, path, entry)
        journal.close_rollback(entry)
        done.append(f"rolled back {entry['folder']}")
    return done


def _partition_folder(spark: SparkSession, values: dict, partition_by: list[str]) -> str:
    """Folder of a partition as Spark names it: special characters coded, NULL and empty by a name of their own."""
    coded = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    return "/".join(coded.getPartitionPathString(c, None if values[c] is None else str(values[c])) for c in partition_by)


def drop_partitions(spark: SparkSession, path: str, partitions: Iterable[dict], partition_by: list[str]) -> None:
    """Remove whole partition folders, given as {column: value}."""
    Journal(spark, path).publish(None, [], [_partition_folder(spark, values, partition_by) for values in partitions])


def delete_where(spark: SparkSession, path: str, schema: StructType, predicate: Column,
                 partition_by: list[str]) -> dict:
    """Delete rows; only partitions that hold such rows are rewritten.

    Returns the removed and remaining row counts. The driver sees one count pair per
    partition, never rows; partitions left empty are dropped as folders. The rows kept are staged first, so a lost task cannot
    leave a half-written partition.
    """
    table = read_table(spark, path, schema)
    doomed = F.coalesce(predicate, F.lit(False))
    counts = (table.groupBy(*partition_by)
              .agg(F.count_if(doomed).alias("removed"), F.count_if(~doomed).alias("kept")))
    found = counts.collect()
    touched = [r for r in found if r["removed"]]
    if any(r["kept"] for r in touched):
        keys = spark.createDataFrame([tuple(r[c] for c in partition_by) for r in touched],
                                     _nullable(StructType([schema[c] for c in partition_by])))
        keys = keys.select(*[F.col(c).alias(f"_key_{c}") for c in partition_by])
        same = [F.col(c).eqNullSafe(F.col(f"_key_{c}")) for c in partition_by]
        kept = table.join(keys, same, "left_semi").where(~doomed)
        staged = scratch_path(spark, "delete")
        kept.write.parquet(staged)
        replace_partitions(spark.read.schema(_nullable(schema)).parquet(staged), path, partition_by)
    drop_partitions(spark, path, [r.asDict() for r in touched if not r["kept"]], partition_by)
    return {"removed": sum(r["removed"] for r in found), "remaining": sum(r["kept"] for r in found)}


def verify_write(table: DataFrame, date: str) -> DataFrame:
    """Rows of the date and of the whole table, in one pass."""
    return table.agg(F.count_if(F.col("date") == date).alias("date_records"),
                     F.count("*").alias("total_records"))


def with_rollback(spark: SparkSession, path: str, schema: StructType, partition: dict,
                  work: Callable[[], None]) -> dict:
    """Run ``work``, which may rewrite one partition; restore the partition if it fails.

    The backup is a folder beside the table, named in its journal, so it outlives the
    driver: should that die, ``recover`` restores the partition at the next start.
    """
    [(column, value)] = partition.items()
    journal = Journal(spark, path)
    entry = {"column": column, "value": value, "folder": _partition_folder(spark, partition, [column]), "had": 0,
             "schema": _nullable(schema).json()}
    backup = journal.backup_path()
    if table_exists(spark, path):
        before = read_table(spark, path, schema, **partition)
        before.write.parquet(backup)
        entry["had"] = spark.read.schema(_nullable(schema)).parquet(backup).count()
    entry = journal.open_rollback(entry, backup)
    try:
        work()
        return {"status": "success", "backed_up": entry["had"]}
    except Exception as error:
        if table_exists(spark, path):
            _restore(spark, path, entry)
        return {"status": "failed", "error": str(error), "backed_up": entry["had"], "rolled_back": True}
    finally:
        journal.close_rollback(entry)


def _restore(spark: SparkSession, path: str, entry: dict) -> None:
    """Put a partition back as its backup has it."""
    schema = StructType.fromJson(json.loads(entry["schema"]))
    saved = spark.read.schema(schema).parquet(entry["backup"]) if entry["had"] else spark.createDataFrame([], schema)
    replace_partitions(saved, path, [entry["column"]], [] if entry["had"] else [{entry["column"]: entry["value"]}])


def register(df: DataFrame, view: str) -> DataFrame:
    """Expose a frame to SQL under a view name."""
    df.createOrReplaceTempView(view)
    return df


def save_as_table(df: DataFrame, database: str, table: str) -> DataFrame:
    """Store a frame in the catalog and return the stored table."""
    spark = df.sparkSession
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    df.write.mode("overwrite").saveAsTable(f"{database}.{table}")
    return spark.table(f"{database}.{table}")
