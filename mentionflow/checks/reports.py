"""Gap assessment, layer status, insights and the dashboard queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates as D
from ..operators.rollups import latest
from ..plans import dashboards as B
from ..plans.insights import insights
from ..plans.status import assess, layer_status
from . import inputs as I
from .registry import check


def _layers(spark, sf):
    """Order dates stand for Bronze, ship dates for Silver, event dates for Gold."""
    def dated(name, column):
        return I.table(spark, sf, name).select(D.day(F.col(column)).alias("date"))
    return dated("orders", "o_orderdate"), dated("lineitem", "l_shipdate"), dated("events", "ts")


_LAYERS = """b AS (SELECT strftime(o_orderdate, '%Y-%m-%d') AS date FROM orders),
s AS (SELECT strftime(l_shipdate, '%Y-%m-%d') AS date FROM lineitem),
g AS (SELECT strftime(ts, '%Y-%m-%d') AS date FROM events),
ms AS (SELECT date FROM b EXCEPT SELECT date FROM s),
mg AS (SELECT date FROM s EXCEPT SELECT date FROM g)"""


@check("g5_assessment", f"""WITH {_LAYERS}, both_gaps AS (SELECT date FROM ms UNION SELECT date FROM mg)
SELECT 'auto' AS mode, CASE WHEN (SELECT count(*) FROM both_gaps) > 0 THEN 'single_run_complete_pipeline'
    ELSE 'single_run_analytics_only' END AS strategy,
  coalesce((SELECT string_agg(date, ',' ORDER BY date) FROM ms), '') AS silver_dates,
  coalesce((SELECT string_agg(date, ',' ORDER BY date) FROM mg), '') AS gold_dates,
  (SELECT max(date) FROM both_gaps) AS target_date, (SELECT count(*) FROM both_gaps) AS process_count,
  (SELECT count(*) FROM ms) > 0 AS process_silver, (SELECT count(*) FROM both_gaps) > 0 AS process_gold,
  true AS process_analytics""")
def g5(spark, sf):
    found = assess(*_layers(spark, sf))
    return (found.withColumn("silver_dates", F.array_join("silver_dates", ","))
            .withColumn("gold_dates", F.array_join("gold_dates", ",")))


@check("g6_layer_status", f"""WITH {_LAYERS}
SELECT 'bronze' AS layer, count(*) AS rows, count(DISTINCT date) AS dates, min(date) AS first_date,
  max(date) AS latest_date, CAST(0 AS BIGINT) AS missing_dates, true AS complete FROM b
UNION ALL SELECT 'silver', count(*), count(DISTINCT date), min(date), max(date),
  (SELECT count(*) FROM ms), (SELECT count(*) FROM ms) = 0 FROM s
UNION ALL SELECT 'gold', count(*), count(DISTINCT date), min(date), max(date),
  (SELECT count(*) FROM mg), (SELECT count(*) FROM mg) = 0 FROM g""")
def g6(spark, sf):
    bronze, silver, gold = _layers(spark, sf)
    return layer_status({"bronze": bronze, "silver": silver, "gold": gold})


@check("g7_insights", f"""WITH {I.GOLD_SQL}, day AS (SELECT * FROM gold WHERE date = (SELECT max(date) FROM gold))
SELECT 'top_categories' AS section, key, value FROM (SELECT technology_category AS key, count(*) AS value FROM day
  GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5)
UNION ALL SELECT 'mention_volumes', mention_volume, count(*) FROM day GROUP BY mention_volume
UNION ALL SELECT 'data_quality', CASE data_completeness WHEN 'complete' THEN 'high' ELSE data_completeness END, count(*)
  FROM day GROUP BY 2
UNION ALL SELECT 'top_technologies', key, value FROM (SELECT technology AS key, daily_mentions AS value FROM day
  ORDER BY 2 DESC, 1 LIMIT 5)
UNION ALL SELECT 'ai_technologies', key, value FROM (SELECT technology AS key, daily_mentions AS value FROM day
  WHERE starts_with(technology_category, 'ai') ORDER BY 2 DESC, 1 LIMIT 3)""")
def g7(spark, sf):
    last = latest(I.table(spark, sf, "events").select(D.day(F.col("ts")).alias("date")), "date")
    return insights(I.gold(spark, sf), last)


# --- dashboards over Silver and Gold ---

@check("g11_quality_leaders", f"""WITH {I.SILVER_SQL}
SELECT date, technology, round_even(data_quality_score, 6) AS data_quality_score, source_record_count FROM silver
WHERE technology <> 'github' ORDER BY silver.data_quality_score DESC, technology, date LIMIT 20""")
def quality_leaders(spark, sf):
    return (B.quality_leaders(I.silver(spark, sf))
            .withColumn("data_quality_score", F.bround("data_quality_score", 6)))


@check("g11_good_rows", f"""WITH {I.SILVER_SQL}
SELECT date, technology, daily_mentions, round_even(data_quality_score, 6) AS data_quality_score, primary_repository
FROM silver WHERE technology <> 'github' AND silver.data_quality_score > 50
ORDER BY daily_mentions DESC, technology, date LIMIT 20""")
def good_rows(spark, sf):
    return B.good_rows(I.silver(spark, sf)).withColumn("data_quality_score", F.bround("data_quality_score", 6))


@check("g11_heavy_rows", f"""WITH {I.SILVER_SQL}
SELECT date, technology, daily_mentions, round_even(data_quality_score, 6) AS data_quality_score, primary_repository
FROM silver WHERE daily_mentions > 10 AND silver.data_quality_score > 51""")
def heavy_rows(spark, sf):
    return (B.heavy_rows(I.silver(spark, sf), min_mentions=10)
            .withColumn("data_quality_score", F.bround("data_quality_score", 6)))


@check("g11_top_technologies", f"""WITH {I.GOLD_SQL}
SELECT technology, CAST(sum(daily_mentions) AS BIGINT) AS total FROM gold GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""")
def top_technologies(spark, sf):
    return B.top_technologies(I.gold(spark, sf))


@check("g11_duplicates", f"""WITH {I.LONG_GOLD_SQL}
SELECT count(*) AS duplicate_keys, coalesce(CAST(sum(n) - count(*) AS BIGINT), 0) AS excess_rows FROM (
  SELECT count(*) AS n FROM long_gold GROUP BY date, technology HAVING count(*) > 1)""")
def duplicates(spark, sf):
    return B.duplicates(I.long_gold(spark, sf))


@check("g11_layer_facts", f"""WITH {I.LONG_GOLD_SQL}
SELECT min(date) AS first_date, max(date) AS last_date, count(DISTINCT date) AS unique_dates,
  count(DISTINCT technology) AS unique_technologies FROM long_gold""")
def layer_facts(spark, sf):
    return B.layer_facts(I.long_gold(spark, sf))


# --- dashboards over the all-time trends ---

_ALLTIME = f"WITH {I.LONG_GOLD_SQL}, {I.trends_sql('long_gold', 'alltime')}"


def _alltime(spark, sf):
    return I.long_trends(spark, sf, "alltime")


@check("g11_top_ranked", f"""{_ALLTIME}
SELECT mention_rank_alltime, technology, technology_category, total_mentions_alltime,
  round_even(avg_daily_mentions_alltime, 6) AS avg_daily_mentions_alltime, peak_day_mentions_alltime,
  days_with_activity_alltime FROM trends ORDER BY mention_rank_alltime, technology, technology_category LIMIT 10""")
def top_ranked(spark, sf):
    return (B.top_ranked(_alltime(spark, sf))
            .withColumn("avg_daily_mentions_alltime", F.bround("avg_daily_mentions_alltime", 6)))


@check("g11_category_rank_values", f"""{_ALLTIME}
SELECT category_rank_alltime, count(*) AS rows FROM trends GROUP BY 1""")
def category_rank_values(spark, sf):
    return B.category_rank_values(_alltime(spark, sf))


@check("g11_behind_leader", f"""{_ALLTIME}
SELECT technology, technology_category, total_mentions_alltime, mention_rank_alltime, category_rank_alltime
FROM trends WHERE category_rank_alltime <> 1
ORDER BY technology_category, category_rank_alltime, technology LIMIT 20""")
def behind_leader(spark, sf):
    return B.behind_leader(_alltime(spark, sf))


@check("g11_category_leaders", f"""{_ALLTIME}
SELECT technology_category, technology, total_mentions_alltime, mention_rank_alltime, category_rank_alltime
FROM trends WHERE category_rank_alltime <= 10 AND technology_category IN ('ECONOMY', 'PROMO', 'LARGE')""")
def category_leaders(spark, sf):
    return B.category_leaders(_alltime(spark, sf), categories=["ECONOMY", "PROMO", "LARGE"])


@check("g11_lone_technologies", f"""WITH {I.GOLD_SQL}, {I.trends_sql('gold', 'alltime')}
SELECT technology, technology_category, category_rank_alltime FROM trends WHERE technology_category IN (
  SELECT technology_category FROM trends GROUP BY 1 HAVING count(*) = 1)""")
def lone_technologies(spark, sf):
    return B.lone_technologies(I.trends(spark, sf, "alltime"))


@check("g11_category_distribution", f"{_ALLTIME} SELECT technology_category, count(*) AS rows FROM trends GROUP BY 1")
def category_distribution(spark, sf):
    from ..operators.rollups import value_counts

    return value_counts(_alltime(spark, sf), "technology_category")


# --- dashboards over the stream table, with event times as processing times ---

def _stream_like(spark, sf):
    return I.table(spark, sf, "events").select(
        F.col("ts").cast("timestamp").alias("processing_time"), F.col("event_type").alias("keyword"),
        F.col("user_id").cast("string").alias("top_repo"), F.lit(1).alias("mentions"), "event_id")


@check("g11_latest_records", """SELECT event_id, event_type AS keyword FROM events
ORDER BY ts DESC, event_type, CAST(user_id AS VARCHAR) LIMIT 10""")
def latest_records(spark, sf):
    return B.latest_records(_stream_like(spark, sf)).select("event_id", "keyword")


@check("g11_records_per_minute", """SELECT strftime(ts, '%Y-%m-%d %H:%M') AS minute, count(*) AS rows FROM events
GROUP BY 1 ORDER BY 1 DESC LIMIT 20""")
def records_per_minute(spark, sf):
    return B.records_per_minute(_stream_like(spark, sf))


@check("g11_last_minute", """SELECT event_id, event_type AS keyword FROM events
WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 1 MINUTE""")
def last_minute(spark, sf):
    stream = _stream_like(spark, sf)
    return B.last_minute(stream, stream.agg(F.max("processing_time")).scalar()).select("event_id", "keyword")


@check("g11_top_stream_keywords", """SELECT event_type AS keyword, count(*) AS total FROM events
GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""")
def top_stream_keywords(spark, sf):
    from ..operators.rollups import top_by_sum

    return top_by_sum(_stream_like(spark, sf), "keyword", "mentions")


@check("g11_rows_of_hour", """SELECT CAST(extract('hour' FROM ts) AS INTEGER) AS hour, count(*) AS rows FROM events
WHERE extract('hour' FROM ts) IN (22, 23) GROUP BY 1""")
def rows_of_hour(spark, sf):
    from ..operators.rollups import counts_by

    hour = F.hour("processing_time")
    return counts_by(_stream_like(spark, sf).where(hour.isin(22, 23)), hour.alias("hour"))
