"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "mentionflow", master: str | None = None,
                  shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """Session with the settings every job relies on: UTC, AQE, dynamic overwrite.

    ``master`` and ``shuffle_partitions`` are for local runs; on a cluster leave
    them to spark-submit.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false")
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared scratch folder and go on from the file.

    Cuts lineage: what several branches of a plan read is computed once and survives
    lost executors. The scan that follows has the true size, so Spark's own broadcast
    limit decides the joins.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for checkpoints and intermediate tables, deleted when the session ends.

    It lies in the folder the session names in ``spark.checkpoint.dir``; where that is
    unset, in the warehouse. On a cluster the warehouse must then be a folder that all
    executors reach; a path on the driver's own disk is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
        if not spark.sparkContext.master.startswith("local") and base.startswith("file:"):
            raise ValueError(f"set spark.checkpoint.dir to a shared folder; executors cannot see {base}")
    path = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(folder)
    return path
