"""The keyword dictionary: small, driver-known, with a checked size."""

from __future__ import annotations

import re
from dataclasses import dataclass
from pathlib import Path

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.rules import CATEGORY_HIERARCHY

DEFAULT_PATH = str(Path(__file__).parent.parent / "resources" / "tech_keywords.json")

# A dictionary up to this size travels inside expressions and broadcasts (well under
# 1 MB). A larger one goes through operators.large_dictionary instead.
MAX_ENTRIES = 10_000

# --- Fixed values: keywords used when no dictionary can be read ---
STREAM_FALLBACK = ["javascript", "python", "docker", "react", "node", "api", "web", "app"]
PRODUCER_FALLBACK = [
    "python", "javascript", "react", "node", "docker", "api", "web", "app", "js", "py", "css",
    "html", "sql", "git", "npm", "pip", "cli", "bot", "server", "client", "lib", "sdk", "tool",
    "framework", "library"]
# --- end of fixed values ---

SCHEMA = "keyword string, raw_type string, ordinal int"


def word_runs(keyword: str) -> list[str]:
    return re.findall(r"\w+", keyword)


@dataclass(frozen=True)
class Dictionary:
    """Entries (keyword, raw type) in dictionary order, keywords lower-cased and unique."""

    entries: tuple[tuple[str, str], ...]

    def __post_init__(self):
        if len(self.entries) > MAX_ENTRIES:
            raise ValueError(f"dictionary has more than {MAX_ENTRIES} entries; use the join forms of operators.large_dictionary")

    @classmethod
    def of(cls, entries, min_chars: int = 1) -> "Dictionary":
        """Trim, lower-case, drop short or repeated keywords; keep the order."""
        kept: dict[str, str] = {}
        for keyword, raw_type in entries:
            cleaned = (keyword or "").strip().lower()
            if len(cleaned) >= min_chars:
                kept.setdefault(cleaned, raw_type or "development_tool")
        return cls(tuple(kept.items()))

    @classmethod
    def from_frame(cls, df: DataFrame, min_chars: int = 1) -> "Dictionary":
        """From (keyword, raw_type, ordinal) rows, cleaned and counted in Spark first.

        More than the bound is an error, never a shorter dictionary: use the join forms.
        """
        cleaned = clean_keywords(df, min_chars)
        if (found := cleaned.count()) > MAX_ENTRIES:
            raise ValueError(f"dictionary has {found} entries, more than {MAX_ENTRIES}; use the join forms of operators.large_dictionary")
        return cls.of([(r.keyword, r.raw_type) for r in cleaned.orderBy("ordinal").collect()], min_chars)

    def keywords(self) -> list[str]:
        return [k for k, _ in self.entries]

    def plain_words(self) -> list[str]:
        return [k for k in self.keywords() if re.fullmatch(r"\w+", k)]

    def phrases(self) -> list[str]:
        return [k for k in self.keywords() if not re.fullmatch(r"\w+", k)]

    def longest(self, n: int) -> list[str]:
        """Most specific keywords: longest first, ties in dictionary order."""
        return sorted(self.keywords(), key=len, reverse=True)[:n]

    def frame(self, spark: SparkSession) -> DataFrame:
        rows = [(k, t, i) for i, (k, t) in enumerate(self.entries)]
        return spark.createDataFrame(rows, SCHEMA)


def clean_keywords(df: DataFrame, min_chars: int = 2) -> DataFrame:
    """The same cleaning for a dictionary of any size, kept as a DataFrame."""
    return (df.withColumn("keyword", F.lower(F.trim("keyword")))
            .where(F.length("keyword") >= min_chars)
            .groupBy("keyword")
            .agg(F.min_by("raw_type", "ordinal").alias("raw_type"), F.min("ordinal").alias("ordinal")))


def longest_keywords(df: DataFrame, n: int) -> DataFrame:
    """The ``n`` longest keywords of a dictionary frame, ties in dictionary order."""
    return df.orderBy(F.length("keyword").desc(), "ordinal").limit(n)


def read_keywords(spark: SparkSession, path: str = DEFAULT_PATH) -> DataFrame:
    """Rows (keyword, raw_type, ordinal) of a ``{keyword: {"type": raw_type}}`` file."""
    parsed = F.from_json("value", "map<string,struct<type:string>>")
    return (spark.read.text(path, wholetext=True)
            .select(F.posexplode(F.map_entries(parsed)).alias("ordinal", "entry"))
            .select(F.col("entry.key").alias("keyword"),
                    F.coalesce("entry.value.type", F.lit("development_tool")).alias("raw_type"),
                    "ordinal"))


def load_dictionary(spark: SparkSession, path: str = DEFAULT_PATH, min_chars: int = 1,
                    fallback: list[str] | None = None) -> Dictionary:
    """Dictionary from a file; an unreadable or empty file yields the fallback, if given."""
    try:
        found = Dictionary.from_frame(read_keywords(spark, path), min_chars)
    except AnalysisException:
        if fallback is None:
            raise
        found = Dictionary(())
    if not found.entries and fallback is not None:
        return Dictionary.of([(k, "development_tool") for k in fallback], min_chars)
    return found


def category_groups(spark: SparkSession) -> DataFrame:
    """The category hierarchy as a dimension: group, category, example technology."""
    rows = [(group, category, example) for group, categories in CATEGORY_HIERARCHY.items()
            for category, examples in categories.items() for example in examples]
    return spark.createDataFrame(rows, "category_group string, technology_category string, example string")
