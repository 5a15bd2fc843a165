"""What is present, what is missing, what to do next."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..operators.gaps import missing_dates

# --- Fixed values: strategy names ---
MANUAL = "manual_full_pipeline"
COMPLETE = "single_run_complete_pipeline"
ANALYTICS_ONLY = "single_run_analytics_only"
# --- end of fixed values ---


def assess(bronze: DataFrame, silver: DataFrame, gold: DataFrame, date: str | None = None) -> DataFrame:
    """One row: mode, strategy, dates each layer has to process, last of them.

    With a ``date`` every layer processes just that date. Date lists are one entry per
    calendar day at most. ``gold_dates`` are the gaps now; Gold looks again after Silver.
    """
    if date is not None:
        dates = F.array(F.lit(date))
        return bronze.sparkSession.range(1).select(
            F.lit("manual").alias("mode"), F.lit(MANUAL).alias("strategy"),
            dates.alias("silver_dates"), dates.alias("gold_dates"), F.lit(date).alias("target_date"),
            F.lit(1).cast("long").alias("process_count"), F.lit(True).alias("process_silver"),
            F.lit(True).alias("process_gold"), F.lit(True).alias("process_analytics"))
    gaps = (missing_dates(bronze, silver).withColumn("layer", F.lit("silver"))
            .unionByName(missing_dates(silver, gold).withColumn("layer", F.lit("gold"))))

    def listed(layer: str):
        return F.array_sort(F.collect_set(F.when(F.col("layer") == layer, F.col("date"))))

    found = gaps.agg(listed("silver").alias("silver_dates"), listed("gold").alias("gold_dates"),
                     F.max("date").alias("target_date"),
                     F.count_distinct("date").alias("process_count"))
    any_silver, any_gold = F.size("silver_dates") > 0, F.size("gold_dates") > 0
    return found.select(
        F.lit("auto").alias("mode"),
        F.when(any_silver | any_gold, COMPLETE).otherwise(ANALYTICS_ONLY).alias("strategy"),
        "silver_dates", "gold_dates", "target_date", "process_count",
        any_silver.alias("process_silver"), (any_silver | any_gold).alias("process_gold"),
        F.lit(True).alias("process_analytics"))


def dates_exist(df: DataFrame, wanted: DataFrame) -> DataFrame:
    """Wanted dates with their row count and whether they are present."""
    counts = df.groupBy("date").agg(F.count("*").alias("records"))
    return (wanted.select("date").distinct().join(counts, "date", "left")
            .select("date", F.coalesce("records", F.lit(0)).alias("records"),
                    (F.coalesce("records", F.lit(0)) > 0).alias("present")))


def layer_status(layers: dict[str, DataFrame]) -> DataFrame:
    """Per layer, in flow order: rows, dates, first and latest date, dates missing from it.

    A layer misses the dates its predecessor has and it lacks.
    """
    rows = []
    before = None
    for name, df in layers.items():
        facts = df.agg(F.count("*").alias("rows"), F.count_distinct("date").alias("dates"),
                       F.min("date").alias("first_date"), F.max("date").alias("latest_date"))
        gap = (F.lit(0).cast("long") if before is None
               else missing_dates(before, df).agg(F.count("*")).scalar())
        rows.append(facts.select(F.lit(name).alias("layer"), "rows", "dates",
                                 F.col("first_date").cast("string"), F.col("latest_date").cast("string"),
                                 gap.alias("missing_dates"))
                    .withColumn("complete", F.col("missing_dates") == 0))
        before = df
    return reduce(DataFrame.unionByName, rows)


def pending(source: DataFrame, target: DataFrame) -> list[str]:
    """Missing dates as a sorted Python list: one short string per calendar day."""
    return [r["date"] for r in missing_dates(source, target).orderBy("date").collect()]
