"""Bronze, Silver, Gold and trend builds."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..functions import dates as D, rules as R
from ..operators import ranking, rollups
from ..plans import daily
from ..plans.bronze import build_bronze, event_matches
from ..plans.gold import categorize
from ..plans.silver import build_silver
from ..plans.partials import date_span, day_partials, month_of, month_partials, trailing_totals
from ..plans.trends import window_bounds
from ..operators.rollups import latest
from ..schemas import GOLD, TIMEFRAMES, trend_schema
from ..session import materialize, scratch_path
from ..sources.tables import read_table
from . import inputs as I
from .registry import check

SILVER_COLUMNS = ("date, technology, daily_mentions, daily_repo_mentions, daily_event_mentions, "
                  "primary_repository, round_even(data_quality_score, 6) AS data_quality_score, "
                  "source_record_count")


def _silver(df):
    return df.select("date", "technology", "daily_mentions", "daily_repo_mentions", "daily_event_mentions",
                     "primary_repository", F.bround("data_quality_score", 6).alias("data_quality_score"),
                     "source_record_count")


@check("a1_hourly_mentions", f"WITH {I.EVENTS_SQL} SELECT date, hour, keyword, mentions FROM bronze")
def a1(spark, sf):
    return I.bronze(spark, sf).select("date", "hour", "keyword", "mentions")


@check("a2_repo_keyword_counts", f"WITH {I.EVENTS_SQL} SELECT date, hour, keyword, repo, repo_mentions FROM per_repo")
def a2(spark, sf):
    return rollups.repo_keyword_counts(I.matches(spark, sf)).drop("first_seen")


@check("a3_hour_totals", f"WITH {I.EVENTS_SQL} SELECT DISTINCT date, hour, event_mentions FROM bronze")
def a3(spark, sf):
    return I.bronze(spark, sf).select("date", "hour", "event_mentions").distinct()


@check("a3_event_type_counts", f"""WITH {I.EVENTS_SQL}
SELECT date, hour, type, count(*) AS matches FROM ev GROUP BY date, hour, type""")
def a3_types(spark, sf):
    return I.matches(spark, sf).groupBy("date", "hour", "type").agg(F.count("*").alias("matches"))


@check("a4_top_repo", f"WITH {I.EVENTS_SQL} SELECT date, hour, keyword, top_repo, repo_mentions FROM bronze")
def a4(spark, sf):
    return I.bronze(spark, sf).select("date", "hour", "keyword", "top_repo", "repo_mentions")


@check("a5_daily_rollup", f"""WITH {I.LONG_BRONZE_SQL}
SELECT date, keyword, CAST(sum(mentions) AS BIGINT) AS daily_mentions,
  CAST(sum(repo_mentions) AS BIGINT) AS daily_repo_mentions,
  CAST(sum(event_mentions) AS BIGINT) AS daily_event_mentions, count(hour) AS source_record_count
FROM long_bronze GROUP BY date, keyword""")
def a5(spark, sf):
    return rollups.daily_rollup(I.long_bronze(spark, sf)).drop("primary_repository")


@check("a6_first_repository", f"""WITH {I.LONG_BRONZE_SQL},
placed AS (SELECT *, row_number() OVER (PARTITION BY date, keyword ORDER BY hour, top_repo) AS place
           FROM long_bronze)
SELECT date, keyword, top_repo AS primary_repository FROM placed WHERE place = 1""")
def a6(spark, sf):
    return (I.long_bronze(spark, sf).groupBy("date", "keyword")
            .agg(rollups.first_by("top_repo", "hour").alias("primary_repository")))


@check("a7_trend_rollup", f"""WITH {I.LONG_GOLD_SQL}
SELECT technology, technology_category, CAST(sum(daily_mentions) AS BIGINT) AS total_mentions,
  round_even(avg(daily_mentions), 6) AS avg_daily_mentions, max(daily_mentions) AS peak_day_mentions,
  count(date) AS days_with_activity
FROM long_gold GROUP BY technology, technology_category""")
def a7(spark, sf):
    return (rollups.trend_rollup(I.long_gold(spark, sf))
            .withColumn("avg_daily_mentions", F.bround("avg_daily_mentions", 6)))


_RANKED = f"""WITH {I.LONG_GOLD_SQL},
totals AS (SELECT technology, technology_category, CAST(sum(daily_mentions) AS BIGINT) AS total_mentions
           FROM long_gold GROUP BY technology, technology_category)"""


@check("w1_overall_rank", _RANKED + """
SELECT technology, technology_category, total_mentions,
  CAST(dense_rank() OVER (ORDER BY total_mentions DESC) AS INTEGER) AS mention_rank FROM totals""")
def w1(spark, sf):
    totals = rollups.trend_rollup(I.long_gold(spark, sf)).select(
        "technology", "technology_category", "total_mentions")
    return ranking.add_dense_ranks(totals, "total_mentions", {"mention_rank": []})


@check("w1_order_price_rank", """SELECT o_orderkey,
  CAST(dense_rank() OVER (ORDER BY CAST(floor(o_totalprice) AS BIGINT) DESC) AS INTEGER) AS price_rank
FROM orders""")
def w1_orders(spark, sf):
    """The overall rank on a table whose keys outgrow any dictionary."""
    orders = I.table(spark, sf, "orders").select("o_orderkey", F.floor("o_totalprice").alias("price"))
    return ranking.add_dense_ranks(orders, "price", {"price_rank": []}).drop("price")


@check("w1_signed_rank", """SELECT c_custkey, CAST(dense_rank() OVER (ORDER BY CAST(floor(c_acctbal) AS BIGINT) DESC) AS INTEGER) AS balance_rank,
  CAST(dense_rank() OVER (PARTITION BY c_nationkey ORDER BY CAST(floor(c_acctbal) AS BIGINT) DESC) AS INTEGER) AS nation_rank FROM customer""")
def w1_signed(spark, sf):
    """Values of both signs."""
    balances = I.table(spark, sf, "customer").select("c_custkey", "c_nationkey", F.floor("c_acctbal").alias("balance"))
    return ranking.add_dense_ranks(balances, "balance", {"balance_rank": [], "nation_rank": ["c_nationkey"]}).drop("balance", "c_nationkey")


@check("w2_category_rank", _RANKED + """
SELECT technology, technology_category, total_mentions,
  CAST(dense_rank() OVER (PARTITION BY technology_category ORDER BY total_mentions DESC) AS INTEGER)
    AS category_rank FROM totals""")
def w2(spark, sf):
    totals = rollups.trend_rollup(I.long_gold(spark, sf)).select(
        "technology", "technology_category", "total_mentions")
    return ranking.add_dense_ranks(totals, "total_mentions", {"category_rank": ["technology_category"]})


@check("w3_top_per_category", _RANKED + """
SELECT * FROM (SELECT technology, technology_category, total_mentions,
  CAST(dense_rank() OVER (PARTITION BY technology_category ORDER BY total_mentions DESC) AS INTEGER)
    AS category_rank FROM totals) WHERE category_rank <= 3""")
def w3(spark, sf):
    return ranking.top_per_group(w2(spark, sf), "category_rank", 3)


@check("w4_quality_score", f"""WITH {I.SILVER_SQL}
SELECT date, technology, round_even(data_quality_score, 6) AS data_quality_score FROM silver""")
def w4(spark, sf):
    return _silver(I.silver(spark, sf)).select("date", "technology", "data_quality_score")


@check("w5_hour_share", f"""WITH {I.EVENTS_SQL}
SELECT date, hour, keyword, round_even(CAST(mentions AS DOUBLE) / event_mentions, 6) AS share FROM bronze""")
def w5(spark, sf):
    """A keyword's part of its hour, from the hour-total window."""
    return I.bronze(spark, sf).select(
        "date", "hour", "keyword",
        F.bround(F.col("mentions").cast("double") / F.col("event_mentions"), 6).alias("share"))


@check("w6_window_bounds", f"""WITH {I.LONG_GOLD_SQL}, anchor AS (SELECT max(date) AS last FROM long_gold)
SELECT '7d' AS timeframe, strftime(CAST(last AS DATE) - 6, '%Y-%m-%d') AS start_date, last AS end_date,
  CAST(7 AS INTEGER) AS days FROM anchor
UNION ALL SELECT '30d', strftime(CAST(last AS DATE) - 29, '%Y-%m-%d'), last, 30 FROM anchor
UNION ALL SELECT '90d', strftime(CAST(last AS DATE) - 89, '%Y-%m-%d'), last, 90 FROM anchor
UNION ALL SELECT 'alltime', (SELECT min(date) FROM long_gold), last,
  (SELECT CAST(count(DISTINCT date) AS INTEGER) FROM long_gold) FROM anchor""")
def w6(spark, sf):
    gold = I.long_gold(spark, sf)
    date = latest(gold, "date")
    frames = [window_bounds(gold, date, t).withColumn("timeframe", F.lit(t))
              for t in ("7d", "30d", "90d", "alltime")]
    return frames[0].unionByName(frames[1]).unionByName(frames[2]).unionByName(frames[3])


@check("w7_completeness", f"""WITH {I.LONG_GOLD_SQL}
SELECT technology, technology_category, round_even(CAST(count(date) AS DOUBLE) / 16 * 100, 1) AS completeness
FROM long_gold GROUP BY technology, technology_category""")
def w7(spark, sf):
    """Sixteenths hit the half-even cases of one decimal."""
    return rollups.trend_rollup(I.long_gold(spark, sf)).select(
        "technology", "technology_category",
        R.completeness_percent(F.col("days_with_activity"), F.lit(16)).alias("completeness"))


# --- layers ---

@check("g1_bronze_from_documents", f"""WITH {I.DOCS_SQL}, {I.MESSAGES_SQL},
{I.DICT_SQL}, {I.PHRASES_SQL}, {I.CAPPED_SQL},
found AS (SELECT date, hour, keyword, repo, doc_id FROM capped JOIN doc_ev USING (doc_id)),
per_repo AS (SELECT date, hour, keyword, repo, count(*) AS n, min(doc_id) AS first_seen
             FROM found GROUP BY ALL),
placed AS (SELECT *, row_number() OVER (PARTITION BY date, hour, keyword ORDER BY n DESC, first_seen, repo) AS place
           FROM per_repo),
facts AS (SELECT hour, keyword, CAST(sum(n) AS BIGINT) AS mentions,
            max(CASE WHEN place = 1 THEN repo END) AS top_repo, max(n) AS repo_mentions, date
          FROM placed GROUP BY date, hour, keyword)
SELECT hour, keyword, mentions, top_repo, repo_mentions,
  CAST(sum(mentions) OVER (PARTITION BY date, hour) AS BIGINT) AS event_mentions, date,
  date || '-batch.json.gz' AS source_file FROM facts""")
def g1(spark, sf):
    return build_bronze(I.doc_events(spark, sf), I.TEXT_DICTIONARY, I.stamp()).drop("processing_time")


@check("g1_bronze_whole_bodies", f"""WITH {I.DOCS_SQL}, {I.MESSAGES_SQL},
{I.DICT_SQL}, {I.PHRASES_SQL}, {I.CAPPED_SQL}
SELECT date, hour, keyword, repo, count(*) AS mentions FROM capped JOIN doc_ev USING (doc_id)
GROUP BY date, hour, keyword, repo""")
def g1_whole(spark, sf):
    """The same matching with pull-request bodies searched in full."""
    found = event_matches(I.doc_events(spark, sf), I.TEXT_DICTIONARY)
    return found.groupBy("date", "hour", "keyword", "repo").agg(F.count("*").alias("mentions"))


@check("g2_silver", f"WITH {I.SILVER_SQL} SELECT {SILVER_COLUMNS} FROM silver")
def g2(spark, sf):
    return _silver(I.silver(spark, sf))


@check("g2_silver_long_span", f"""WITH {I.LONG_BRONZE_SQL},
daily AS (
  SELECT date, keyword AS technology, CAST(sum(mentions) AS BIGINT) AS daily_mentions,
    CAST(sum(repo_mentions) AS BIGINT) AS daily_repo_mentions,
    CAST(sum(event_mentions) AS BIGINT) AS daily_event_mentions,
    min((hour, top_repo)) AS lead, CAST(count(hour) AS INTEGER) AS source_record_count
  FROM long_bronze GROUP BY date, keyword)
SELECT date, technology, daily_mentions, daily_repo_mentions, daily_event_mentions,
  lead[2] AS primary_repository,
  round_even(least(greatest(CAST(daily_mentions AS DOUBLE) / max(daily_mentions) OVER (PARTITION BY date) * 50
    + CAST(source_record_count AS DOUBLE) / 24 * 30 + 20, 0), 100), 6) AS data_quality_score,
  source_record_count FROM daily""")
def g2_long(spark, sf):
    return _silver(build_silver(I.long_bronze(spark, sf), I.stamp()))


@check("g3_gold", f"WITH {I.GOLD_SQL} SELECT * FROM gold")
def g3(spark, sf):
    return I.gold(spark, sf).drop("processed_at", "data_source")


def _trend_check(timeframe: str):
    @check(f"g4_trends_{timeframe}", f"""WITH {I.GOLD_SQL}, {I.trends_sql('gold', timeframe)}
SELECT * REPLACE (round_even(avg_daily_mentions_{timeframe}, 6) AS avg_daily_mentions_{timeframe}) FROM trends""")
    def g4(spark, sf):
        name = f"avg_daily_mentions_{timeframe}"
        return I.trends(spark, sf, timeframe).withColumn(name, F.bround(name, 6))

    @check(f"g4_trends_{timeframe}_long_span",
           f"""WITH {I.LONG_GOLD_SQL}, {I.trends_sql('long_gold', timeframe)}
SELECT * REPLACE (round_even(avg_daily_mentions_{timeframe}, 6) AS avg_daily_mentions_{timeframe}) FROM trends""")
    def g4_long(spark, sf):
        name = f"avg_daily_mentions_{timeframe}"
        return I.long_trends(spark, sf, timeframe).withColumn(name, F.bround(name, 6))


for _t in ("7d", "30d", "90d", "alltime"):
    _trend_check(_t)


def _all_timeframes_sql(base: str, source: str) -> str:
    return " UNION ALL ".join(f"""SELECT '{t}' AS timeframe, technology, technology_category, total_mentions_{t} AS total_mentions,
  round_even(avg_daily_mentions_{t}, 6) AS avg_daily_mentions, peak_day_mentions_{t} AS peak_day_mentions, days_with_activity_{t} AS days_with_activity,
  mention_rank_{t} AS mention_rank, category_rank_{t} AS category_rank, data_completeness_{t} AS data_completeness
FROM (WITH {base}, {I.trends_sql(source, t)} SELECT * FROM trends)""" for t in TIMEFRAMES)


def _all_timeframes(gold: DataFrame) -> DataFrame:
    """All trend tables from one read of Gold: its partials by day and closed month."""
    days = materialize(day_partials(gold), "day-partials")
    date = latest(days, "date")
    months = sorted({r["date"][:7] + "-01" for r in days.select("date").distinct().collect() if r["date"][:7] < date[:7]})
    merged = materialize(month_partials(days.where(month_of(F.col("date")).isin(months))), "month-partials")
    partials = days.unionByName(merged)
    totals = materialize(trailing_totals(partials, date, months), "trailing-totals")
    span = tuple(date_span(partials, date).first())
    names = ["total_mentions", "avg_daily_mentions", "peak_day_mentions", "days_with_activity", "mention_rank", "category_rank", "data_completeness"]
    tables = [daily.ranked_trends(totals, date, t, span).select(
        F.lit(t).alias("timeframe"), "technology", "technology_category",
        *[(F.bround(f"{n}_{t}", 6) if n.startswith("avg") else F.col(f"{n}_{t}")).alias(n) for n in names]) for t in TIMEFRAMES]
    return reduce(DataFrame.unionByName, tables)


@check("g4_all_timeframes", _all_timeframes_sql(I.GOLD_SQL, "gold"))
def g4_all(spark, sf):
    return _all_timeframes(I.gold(spark, sf))


@check("g4_all_timeframes_long_span", _all_timeframes_sql(I.LONG_GOLD_SQL, "long_gold"))
def g4_all_long(spark, sf):
    return _all_timeframes(I.long_gold(spark, sf))


def _daily(spark, sf):
    """The whole batch over stored tables, run twice."""
    root = scratch_path(spark, "daily")
    layout = daily.Layout(root)
    daily.write_bronze(I.bronze(spark, sf), layout)
    for _ in range(2):
        report = daily.run_daily(spark, root, I.EVENT_DICTIONARY)
    return layout, report


@check("g9_daily_run", f"WITH {I.GOLD_SQL} SELECT * FROM gold")
def g9(spark, sf):
    return read_table(spark, _daily(spark, sf)[0].gold, GOLD).drop("processed_at", "data_source")


_G9_TRENDS = "UNION ALL ".join(
    f"""SELECT '{t}' AS timeframe, technology, total_mentions_{t} AS total_mentions, mention_rank_{t} AS mention_rank, category_rank_{t} AS category_rank
FROM (WITH {I.GOLD_SQL}, {I.trends_sql('gold', t)} SELECT * FROM trends) """ for t in ("7d", "30d", "90d", "alltime"))


@check("g9_daily_run_trends", _G9_TRENDS)
def g9_trends(spark, sf):
    """The four trend tables that the batch leaves behind."""
    layout, _ = _daily(spark, sf)
    names = ("total_mentions", "mention_rank", "category_rank")
    parts = [read_table(spark, layout.trends(t), trend_schema(t)).select(
        F.lit(t).alias("timeframe"), "technology", *[F.col(f"{n}_{t}").alias(n) for n in names]) for t in ("7d", "30d", "90d", "alltime")]
    return reduce(DataFrame.unionByName, parts)


# --- classification rules ---

_NAMES_SQL = r"""names AS (
  SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}_]+')) AS technology FROM documents)"""


def _names(spark, sf):
    from ..functions.text import tokens

    return (I.table(spark, sf, "documents")
            .select(F.explode(F.array_distinct(tokens(F.col("text")))).alias("technology")).distinct())


@check("r1_standard_category", f"""WITH {I.DICT_SQL}
SELECT doc_id, label, category FROM (
  SELECT l.doc_id, d.raw_type AS label, CASE d.raw_type
    WHEN 'css_framework' THEN 'web_framework' WHEN 'ci_cd' THEN 'devops' WHEN 'orm' THEN 'library'
    WHEN 'tool' THEN 'development_tool' WHEN 'no such type' THEN 'development_tool'
    WHEN 'nlp' THEN 'ai_framework' WHEN 'monitoring' THEN 'devops' WHEN 'data_library' THEN 'data_analysis'
    WHEN 'blockchain' THEN 'blockchain_platform' ELSE d.raw_type END AS category
  FROM documents l JOIN dict d ON l.doc_id % 23 = d.ordinal)""")
def r1(spark, sf):
    """Every document takes one of the dictionary's raw types."""
    types = F.array(*[F.lit(t) for _, t in I.TEXT_DICTIONARY.entries])
    label = F.element_at(types, (F.col("doc_id") % 23 + 1).cast("int"))
    return I.table(spark, sf, "documents").select(
        "doc_id", label.alias("label"), R.standard_category(label).alias("category"))


@check("r2_inferred_category", f"WITH {_NAMES_SQL} SELECT technology, {I.inferred_sql('technology')} AS category FROM names")
def r2(spark, sf):
    return _names(spark, sf).withColumn("category", R.inferred_category(F.col("technology")))


@check("j1_category_lookup", f"""WITH {_NAMES_SQL}, {I.DICT_SQL}
SELECT n.technology, CASE WHEN d.keyword IS NOT NULL THEN CASE d.raw_type
    WHEN 'css_framework' THEN 'web_framework' WHEN 'ci_cd' THEN 'devops' WHEN 'orm' THEN 'library'
    WHEN 'monitoring' THEN 'devops' WHEN 'data_library' THEN 'data_analysis'
    WHEN 'blockchain' THEN 'blockchain_platform' ELSE d.raw_type END
  ELSE {I.inferred_sql('n.technology')} END AS technology_category
FROM names n LEFT JOIN dict d ON n.technology = d.keyword""")
def j1(spark, sf):
    return categorize(_names(spark, sf), I.TEXT_DICTIONARY)


@check("r3_mention_volume", f"""WITH {I.LONG_GOLD_SQL}
SELECT technology, technology_category, total_mentions, CASE WHEN total_mentions >= 1000 THEN 'high'
  WHEN total_mentions >= 100 THEN 'medium' WHEN total_mentions >= 10 THEN 'low' ELSE 'minimal' END AS volume
FROM (SELECT technology, technology_category, CAST(sum(daily_mentions) AS BIGINT) AS total_mentions
      FROM long_gold GROUP BY technology, technology_category)""")
def r3(spark, sf):
    return rollups.trend_rollup(I.long_gold(spark, sf)).select(
        "technology", "technology_category", "total_mentions",
        R.mention_volume(F.col("total_mentions")).alias("volume"))


@check("r4_completeness_flag", """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, strftime(l_shipdate, '%Y-%m-%d') AS day,
  CASE WHEN l_discount > 0 THEN 'complete' ELSE 'empty' END AS flag,
  CASE WHEN l_discount > 0 THEN 'high' ELSE 'empty' END AS label FROM lineitem""")
def r4(spark, sf):
    flag = R.completeness_flag(F.col("l_discount"))
    return I.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", D.day(F.col("l_shipdate")).alias("day"),
        flag.alias("flag"), R.completeness_label(flag).alias("label"))


@check("r5_hotness", f"""WITH {I.LONG_GOLD_SQL}
SELECT technology, technology_category, CASE WHEN avg(daily_mentions) * 2 >= 200 THEN 'hot'
  WHEN avg(daily_mentions) * 2 >= 50 THEN 'warm' ELSE 'cool' END AS signal
FROM long_gold GROUP BY technology, technology_category""")
def r5(spark, sf):
    return rollups.trend_rollup(I.long_gold(spark, sf)).select(
        "technology", "technology_category", R.hotness(F.col("avg_daily_mentions") * 2).alias("signal"))


@check("r6_group_totals", f"""WITH {I.GOLD_SQL},
groups(category_group, technology_category) AS (VALUES {", ".join(f"('{group}', '{category}')" for group, categories in R.CATEGORY_HIERARCHY.items() for category in categories)})
SELECT category_group, count(*) AS rows, CAST(sum(daily_mentions) AS BIGINT) AS mentions
FROM gold JOIN groups USING (technology_category) GROUP BY category_group""")
def r6(spark, sf):
    from ..sources.dictionary import category_groups

    groups = category_groups(spark).select("category_group", "technology_category").distinct()
    return (I.gold(spark, sf).join(F.broadcast(groups), "technology_category").groupBy("category_group")
            .agg(F.count("*").alias("rows"), F.sum("daily_mentions").alias("mentions")))


@check("f2_classified_rows", f"""WITH {I.GOLD_SQL}
SELECT technology_category, mention_volume, data_completeness, count(*) AS rows
FROM gold GROUP BY ALL""")
def f2(spark, sf):
    return (I.gold(spark, sf).groupBy("technology_category", "mention_volume", "data_completeness")
            .agg(F.count("*").alias("rows")))


@check("f3_group_transform", """SELECT o_orderkey, o_orderstatus,
  CASE WHEN count(*) OVER (PARTITION BY o_orderstatus, o_custkey) > 1
    THEN CAST(dense_rank() OVER (PARTITION BY o_orderstatus, o_custkey
      ORDER BY CAST(floor(o_totalprice) AS BIGINT) DESC) AS INTEGER) ELSE 1 END AS place,
  CASE WHEN o_totalprice >= 200 THEN 'hot' WHEN o_totalprice >= 50 THEN 'warm' ELSE 'cool' END AS signal
FROM orders""")
def f3(spark, sf):
    orders = I.table(spark, sf, "orders").select(
        "o_orderkey", "o_orderstatus", "o_custkey", F.floor("o_totalprice").alias("price"),
        R.hotness(F.col("o_totalprice")).alias("signal"))
    ranked = ranking.add_dense_ranks(orders, "price", {"place": ["o_orderstatus", "o_custkey"]})
    return ranked.select("o_orderkey", "o_orderstatus", "place", "signal")
