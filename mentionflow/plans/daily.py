"""The daily batch in one call: assess, Silver, Gold, trends, status."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ..operators.gaps import valid_dates
from ..operators.quality import require_valid
from ..operators.rollups import latest
from ..schemas import BRONZE, GOLD, PARTIALS, SILVER, TIMEFRAMES, trend_schema
from ..session import materialize, scratch_path
from ..sources import tables
from ..sources.dictionary import Dictionary
from .gold import build_gold
from .partials import DAY, MONTH, date_span, day_partials, month_partials, trailing_totals
from .silver import build_silver
from .status import assess, layer_status, pending
from .trends import rank_trends, window_rows

# --- Fixed values: table names, thresholds ---
BRONZE_NAME, SILVER_NAME, GOLD_NAME = "keyword_extractions", "keyword_trends", "technology_daily_activity"
TREND_NAME = "technology_trends_{}"
MIN_BRONZE_RECORDS = 5
# --- end of fixed values ---


@dataclass
class Layout:
    """Where the tables live."""

    root: str
    bronze: str = field(init=False)
    silver: str = field(init=False)
    gold: str = field(init=False)
    partials: str = field(init=False)

    def __post_init__(self):
        self.bronze = tables.table_path(self.root, "bronze", BRONZE_NAME)
        self.silver = tables.table_path(self.root, "silver", SILVER_NAME)
        self.gold = tables.table_path(self.root, "gold", GOLD_NAME)
        self.partials = tables.table_path(self.root, "analytics", "trend_partials")

    def all(self) -> list[str]:
        return [self.bronze, self.silver, self.gold, self.partials, *map(self.trends, TIMEFRAMES)]

    def trends(self, timeframe: str) -> str:
        return tables.table_path(self.root, "analytics", TREND_NAME.format(timeframe))


def create_tables(spark: SparkSession, layout: Layout) -> None:
    """Create what is absent; existing tables keep their rows."""
    tables.create_if_absent(spark, layout.silver, SILVER, ["date"])
    tables.create_if_absent(spark, layout.gold, GOLD, ["date"])
    tables.create_if_absent(spark, layout.partials, PARTIALS, ["span", "date"])
    for timeframe in TIMEFRAMES:
        tables.create_if_absent(spark, layout.trends(timeframe), trend_schema(timeframe), ["analysis_date"])


def write_bronze(facts: DataFrame, layout: Layout) -> None:
    """Store hourly facts; a date that comes again is replaced."""
    tables.replace_partitions(facts, layout.bronze, ["date"], lookup=["keyword"])


def publish(df: DataFrame, path: str, schema: StructType, partition_by: list[str], layer: str) -> DataFrame:
    """Stage a frame, check it against its schema, then replace its partitions.

    The plan runs once; what is checked is what is published. Returns the staged rows.
    """
    spark = df.sparkSession
    staged = scratch_path(spark, "publish")
    df.write.parquet(staged)
    rows = tables.read_table(spark, staged, schema)
    require_valid(rows, schema, layer)
    tables.replace_partitions(rows, path, partition_by, lookup=["technology"])
    return rows


def _dates(df: DataFrame, dates: list[str]) -> DataFrame:
    """Partition filter for a list of calendar days."""
    return df.where(F.col("date").isin(dates))


def run_silver(spark: SparkSession, layout: Layout, dates: list[str], minimum: int = MIN_BRONZE_RECORDS) -> dict:
    """Rebuild the given dates of Silver from the Bronze dates with at least ``minimum`` records.

    Dates with fewer are named in ``dates_skipped``.
    """
    if not dates:
        return {"status": "skipped", "reason": "no_silver_dates"}
    bronze = _dates(tables.read_table(spark, layout.bronze, BRONZE), dates)
    usable = [r["date"] for r in valid_dates(bronze, minimum).select("date").collect()]
    if not usable:
        return {"status": "failed", "error": "0 dates have valid Bronze data", "dates_skipped": sorted(dates)}
    written = publish(build_silver(_dates(bronze, usable)), layout.silver, SILVER, ["date"], "Silver")
    count, mentions = written.agg(F.count("*"), F.sum("daily_mentions")).first()
    return {"status": "success", "dates_processed": sorted(usable), "dates_skipped": sorted(set(dates) - set(usable)), "total_technologies": count,
            "total_mentions": mentions}


def run_gold(spark: SparkSession, layout: Layout, dictionary: Dictionary, dates: list[str] | None = None) -> dict:
    """Classify the Silver dates Gold lacks (looked up now), or the given dates."""
    silver = tables.read_table(spark, layout.silver, SILVER)
    if dates is None:
        dates = pending(silver, tables.read_table(spark, layout.gold, GOLD))
    if not dates:
        return {"status": "skipped", "reason": "gold_up_to_date"}
    written = publish(build_gold(_dates(silver, dates), dictionary), layout.gold, GOLD, ["date"], "Gold")
    refresh_partials(spark, layout, dates)
    return {"status": "success", "dates_processed": sorted(dates), "technologies_classified": written.count()}


def refresh_partials(spark: SparkSession, layout: Layout, dates: list[str]) -> None:
    """Rebuild the partials of the given Gold dates, and of the closed months that hold them.

    Only these dates of Gold are read. A month is closed once a later one has begun; its
    partials are merged from its days'. The driver sees dates only.
    """
    tables.create_if_absent(spark, layout.partials, PARTIALS, ["span", "date"])
    days = materialize(day_partials(_dates(tables.read_table(spark, layout.gold, GOLD), dates)), "day-partials")
    kept = {r["date"] for r in days.select("date").distinct().collect()}
    tables.replace_partitions(days, layout.partials, ["span", "date"], [{"span": DAY, "date": d} for d in dates if d not in kept])
    partials = tables.read_table(spark, layout.partials, PARTIALS)  # lists the files anew
    known = sorted(r["date"] for r in partials.where(F.col("span") == DAY).select("date").distinct().collect())
    if not known:
        return
    built = {r["date"] for r in partials.where(F.col("span") == MONTH).select("date").distinct().collect()}
    closed = {d[:7] + "-01" for d in known if d[:7] < known[-1][:7]}
    due = sorted(m for m in closed if m not in built or any(d[:7] == m[:7] for d in dates))
    stale = [{"span": MONTH, "date": m} for m in built - closed]
    if due or stale:
        of_month = partials.where((F.col("span") == DAY) & F.substring("date", 1, 7).isin([m[:7] for m in due]))
        tables.replace_partitions(materialize(month_partials(of_month), "month-partials"), layout.partials, ["span", "date"], stale)


def run_trends(spark: SparkSession, layout: Layout, analysis_date: str | None = None) -> dict:
    """All four trend tables; one that fails keeps its old rows and the others go on.

    All timeframes come from one pass over the partials. Gold is asked for its dates only,
    and read where dates have no partials yet.
    """
    gold = tables.read_table(spark, layout.gold, GOLD)
    date = analysis_date or latest(gold, "date")
    if date is None:
        return {"status": "blocked", "reason": "no_gold_data"}
    tables.create_if_absent(spark, layout.partials, PARTIALS, ["span", "date"])
    partials = tables.read_table(spark, layout.partials, PARTIALS)
    missing = pending(gold, partials.where(F.col("span") == DAY))
    if missing:
        refresh_partials(spark, layout, missing)
        partials = tables.read_table(spark, layout.partials, PARTIALS)
    months = [r["date"] for r in partials.where(F.col("span") == MONTH).select("date").distinct().collect()]
    totals = materialize(trailing_totals(partials, date, months), "trailing-totals")
    span = tuple(date_span(partials, date).first())
    found = totals.agg(*[F.count(f"`{t}`").alias(t) for t in TIMEFRAMES]).first()
    results = {}
    for timeframe in TIMEFRAMES:
        path, schema = layout.trends(timeframe), trend_schema(timeframe)

        def work():
            publish(ranked_trends(totals, date, timeframe, span), path, schema, ["analysis_date"],
                    f"Trends {timeframe}")

        if not found[timeframe]:
            results[timeframe] = {"status": "skipped", "reason": "no_data"}
            continue
        results[timeframe] = tables.with_rollback(spark, path, schema, {"analysis_date": date}, work)
    return {"status": overall_status(results), "analysis_date": date, "results": results}


def ranked_trends(totals: DataFrame, date: str, timeframe: str, span: tuple[str, int]) -> DataFrame:
    """The trend table of one timeframe from the totals of all."""
    return rank_trends(materialize(window_rows(totals, date, timeframe, span), f"trends-{timeframe}"), date, timeframe)


def overall_status(results: dict[str, dict]) -> str:
    """success when all timeframes succeed, partial_success when some do, else failed."""
    good = sum(r["status"] == "success" for r in results.values())
    return "success" if good == len(results) else "partial_success" if good else "failed"


def run_daily(spark: SparkSession, root: str, dictionary: Dictionary, date: str | None = None) -> dict:
    """Bring Silver, Gold and the trend tables up to date with Bronze.

    The assessment decides the strategy and the dates of each layer: a given date is
    reprocessed in every layer, otherwise each layer fills its gaps, and Gold looks again
    after Silver. What a run that died had begun is finished or taken back first. The driver
    handles dates and statuses only.
    """
    layout = Layout(root)
    for path in layout.all():
        tables.recover(spark, path)
    create_tables(spark, layout)
    bronze = tables.read_table(spark, layout.bronze, BRONZE)
    plan = assess(bronze, tables.read_table(spark, layout.silver, SILVER), tables.read_table(spark, layout.gold, GOLD), date).first()
    silver = run_silver(spark, layout, list(plan.silver_dates))
    gold = run_gold(spark, layout, dictionary, list(plan.gold_dates) if date else None)
    trends = run_trends(spark, layout)
    status = layer_status({
        "bronze": bronze, "silver": tables.read_table(spark, layout.silver, SILVER),
        "gold": tables.read_table(spark, layout.gold, GOLD)})
    return {"strategy": plan.strategy, "silver": silver, "gold": gold, "trends": trends,
            "layers": [r.asDict() for r in status.collect()]}
