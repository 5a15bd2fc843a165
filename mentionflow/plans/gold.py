"""Daily trends to classified daily activity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import rules as R
from ..schemas import GOLD, conform
from ..sources.dictionary import Dictionary


def categorize(df: DataFrame, dictionary: Dictionary, column: str = "technology",
               name: str = "technology_category") -> DataFrame:
    """Adds the category: from the dictionary, else guessed from the name.

    The dictionary is within its checked bound, so the lookup is a broadcast left join;
    the guess is evaluated only for names it lacks.
    """
    lookup = dictionary.frame(df.sparkSession).select(
        F.col("keyword").alias("_keyword"), R.standard_category(F.col("raw_type")).alias("_category"))
    joined = df.join(F.broadcast(lookup), F.lower(F.trim(F.col(column))) == F.col("_keyword"), "left")
    guess = R.inferred_category(F.col(column))
    return (joined.withColumn(name, F.coalesce(F.col("_category"), guess))
            .drop("_keyword", "_category"))


def build_gold(silver: DataFrame, dictionary: Dictionary, processed_at: Column | None = None) -> DataFrame:
    """Classified rows; no shuffle, so it runs at the speed of the scan."""
    mentions = F.col("daily_mentions")
    classified = (categorize(silver, dictionary)
                  .withColumn("mention_volume", R.mention_volume(mentions))
                  .withColumn("data_completeness", R.completeness_flag(mentions))
                  .withColumn("processed_at", F.current_timestamp() if processed_at is None else processed_at)
                  .withColumn("data_source", F.lit("github_silver")))
    return conform(classified, GOLD)
