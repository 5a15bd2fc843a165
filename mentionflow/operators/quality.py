"""Schema and data checks."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType


@dataclass
class Validation:
    """Outcome of a schema check."""

    missing: list[str] = field(default_factory=list)
    extra: list[str] = field(default_factory=list)
    wrong_type: dict[str, tuple[str, str]] = field(default_factory=dict)
    nulls: dict[str, int] = field(default_factory=dict)

    @property
    def ok(self) -> bool:
        """Extra columns are only a warning."""
        return not (self.missing or self.wrong_type or self.nulls)


def schema_difference(df: DataFrame, schema: StructType) -> Validation:
    """Missing, extra and wrongly typed columns; reads no data."""
    have = {f.name: f.dataType for f in df.schema.fields}
    want = {f.name: f.dataType for f in schema.fields}
    return Validation(
        missing=[n for n in want if n not in have],
        extra=[n for n in have if n not in want],
        wrong_type={n: (t.simpleString(), have[n].simpleString())
                    for n, t in want.items() if n in have and have[n] != t})


def null_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """NULLs per column in one pass, one row per column."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], columns, "column", "nulls")


def validate(df: DataFrame, schema: StructType) -> Validation:
    """Schema check plus one job that counts NULLs in required columns."""
    found = schema_difference(df, schema)
    required = [f.name for f in schema.fields if not f.nullable and f.name not in found.missing]
    if required:
        found.nulls = {r["column"]: r["nulls"] for r in null_counts(df, required).collect() if r["nulls"]}
    return found


def require_valid(df: DataFrame, schema: StructType, layer: str) -> None:
    """Stop a write whose frame does not fit the layer's schema."""
    found = validate(df, schema)
    if not found.ok:
        raise ValueError(f"{layer} does not fit its schema: {found}")


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(*keys).agg(F.count("*").alias("rows")).where("rows > 1")


def duplicate_summary(df: DataFrame, keys: list[str]) -> DataFrame:
    """Number of repeated keys and of rows beyond the first of each."""
    return duplicate_keys(df, keys).agg(
        F.count("*").alias("duplicate_keys"),
        F.coalesce(F.sum("rows") - F.count("*"), F.lit(0)).alias("excess_rows"))
