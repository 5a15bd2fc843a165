"""The daily insight report."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..functions.rules import completeness_label
from ..operators.rollups import counts_by


def insights(gold: DataFrame, date: str) -> DataFrame:
    """Rows (section, key, value) for a date.

    Sections: the five largest categories, the volume mix, data quality, the five
    technologies and the three AI technologies mentioned most.
    """
    day = gold.where(F.col("date") == date)

    def section(name: str, df: DataFrame, key, value) -> DataFrame:
        return df.select(F.lit(name).alias("section"), key.alias("key"), value.cast("long").alias("value"))

    def counted(name: str, key, top: int | None = None) -> DataFrame:
        counts = counts_by(day, key.alias("k"))
        if top is not None:
            counts = counts.orderBy(F.desc("rows"), "k").limit(top)
        return section(name, counts, F.col("k"), F.col("rows"))

    def leaders(name: str, df: DataFrame, top: int) -> DataFrame:
        best = df.orderBy(F.desc("daily_mentions"), "technology").limit(top)
        return section(name, best, F.col("technology"), F.col("daily_mentions"))

    ai = day.where(F.startswith("technology_category", F.lit("ai")))
    return reduce(DataFrame.unionByName, [
        counted("top_categories", F.col("technology_category"), 5),
        counted("mention_volumes", F.col("mention_volume")),
        counted("data_quality", completeness_label(F.col("data_completeness"))),
        leaders("top_technologies", day, 5),
        leaders("ai_technologies", ai, 3),
    ])
