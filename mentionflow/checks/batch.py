"""Filters, aggregates, joins, sorts and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates as D, rules as R
from ..operators import distinct, gaps, quality, ranking, rollups, sampling
from ..operators.versions import read_as_of, recent, retain_hours, retention_report, without
from ..plans.status import dates_exist
from ..session import scratch_path
from ..sources.events import with_provenance
from ..sources.tables import verify_write
from . import inputs as I
from .registry import check


def _orders(spark, sf):
    return I.table(spark, sf, "orders").withColumn("date", D.day(F.col("o_orderdate")))


def _items(spark, sf):
    return I.table(spark, sf, "lineitem").withColumn("date", D.day(F.col("l_shipdate")))


ORDER_DATES = "strftime(o_orderdate, '%Y-%m-%d')"
SHIP_DATES = "strftime(l_shipdate, '%Y-%m-%d')"


# --- P: filters ---

@check("p6_trailing_window", f"""WITH {I.LONG_BRONZE_SQL}, anchor AS (SELECT max(date) AS last FROM long_bronze)
SELECT date, keyword, count(*) AS rows FROM long_bronze, anchor
WHERE date BETWEEN strftime(CAST(last AS DATE) - 29, '%Y-%m-%d') AND last GROUP BY date, keyword""")
def p6(spark, sf):
    facts = I.long_bronze(spark, sf)
    last = F.lit(rollups.latest(facts, "date"))
    return rollups.counts_by(facts.where(D.in_window(F.col("date"), last, 30)), "date", "keyword")


_KINDS = "CASE event_type WHEN 'view' THEN 'star' WHEN 'click' THEN 'push' WHEN 'error' THEN 'issue' ELSE event_type END"


@check("p7_noise", f"""SELECT technology, count(*) AS mentions FROM (SELECT {_KINDS} AS technology FROM events)
WHERE technology NOT IN ('github', 'repository', 'repo', 'commit', 'branch', 'pull', 'push', 'clone', 'fork',
  'star', 'issue', 'pr') GROUP BY technology""")
def p7(spark, sf):
    """Event types under the names a code host uses; the noise words leave after counting."""
    kind = (F.when(F.col("event_type") == "view", "star").when(F.col("event_type") == "click", "push")
            .when(F.col("event_type") == "error", "issue").otherwise(F.col("event_type")))
    counted = (I.table(spark, sf, "events").groupBy(kind.alias("technology"))
               .agg(F.count("*").alias("mentions")))
    return counted.where(R.not_noise(F.col("technology")))


@check("p8_valid_dates", f"""SELECT {SHIP_DATES} AS date, count(*) AS records FROM lineitem GROUP BY 1
HAVING count(*) >= 5""")
def p8(spark, sf):
    return gaps.valid_dates(_items(spark, sf), 5)


@check("p8_complete_dates", f"""SELECT {SHIP_DATES} AS date, count(*) AS records FROM lineitem GROUP BY 1
HAVING count(*) > 5""")
def p8_strict(spark, sf):
    return gaps.valid_dates(_items(spark, sf), 5, strict=True)


@check("p9_layer_projection", f"""WITH {I.LONG_BRONZE_SQL}
SELECT CAST(hour AS INTEGER) AS hour, keyword, CAST(mentions AS BIGINT) AS mentions, top_repo,
  CAST(repo_mentions AS BIGINT) AS repo_mentions, CAST(event_mentions AS BIGINT) AS event_mentions, date,
  date || '-batch.json.gz' AS source_file FROM long_bronze""")
def p9(spark, sf):
    from ..schemas import BRONZE, conform

    facts = with_provenance(I.long_bronze(spark, sf), F.col("date"), I.stamp())
    return conform(facts, BRONZE).drop("processing_time")


@check("p10_threshold_filter", f"""WITH {I.SILVER_SQL}
SELECT date, technology, daily_mentions, round_even(data_quality_score, 6) AS data_quality_score, primary_repository
FROM silver WHERE technology <> 'view-0' AND data_quality_score > 50 AND daily_mentions > 8""")
def p10(spark, sf):
    from ..plans.dashboards import ACTIVITY, filter_silver

    return (filter_silver(I.silver(spark, sf), "view-0", 50, 8).select("date", *ACTIVITY)
            .withColumn("data_quality_score", F.bround("data_quality_score", 6)))


@check("p11_category_prefix", f"""WITH {I.GOLD_SQL}
SELECT date, technology, technology_category, daily_mentions FROM gold
WHERE starts_with(technology_category, 'ai') OR technology_category = 'language'""")
def p11(spark, sf):
    category = F.col("technology_category")
    return (I.gold(spark, sf).where(F.startswith(category, F.lit("ai")) | (category == "language"))
            .select("date", "technology", "technology_category", "daily_mentions"))


@check("p12_recent_rows", """SELECT event_id, event_type FROM events
WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 90 MINUTE""")
def p12(spark, sf):
    events = I.table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    now = events.agg(F.max("ts")).scalar()
    return recent(events, "ts", "90 minutes", now).select("event_id", "event_type")


# --- A: aggregates ---

@check("a9_rows_per_date", f"SELECT {SHIP_DATES} AS date, count(*) AS rows FROM lineitem GROUP BY 1")
def a9_date(spark, sf):
    return rollups.counts_by(_items(spark, sf), "date")


@check("a9_rows_per_hour", f"WITH {I.EVENTS_SQL} SELECT date, hour, count(*) AS rows FROM ev GROUP BY 1, 2")
def a9_hour(spark, sf):
    return rollups.counts_by(I.matches(spark, sf), "date", "hour")


@check("a9_rows_per_minute", "SELECT strftime(ts, '%Y-%m-%d %H:%M') AS minute, count(*) AS rows FROM events GROUP BY 1")
def a9_minute(spark, sf):
    return rollups.counts_by(I.table(spark, sf, "events"), D.minute_bucket(F.col("ts")).alias("minute"))


@check("a10_distinct_dates", f"SELECT DISTINCT {ORDER_DATES} AS date FROM orders")
def a10(spark, sf):
    return gaps.dates_of(_orders(spark, sf))


@check("a10_distinct_counts", f"""WITH {I.LONG_BRONZE_SQL}
SELECT count(DISTINCT date) AS dates, count(DISTINCT keyword) AS keywords, count(DISTINCT top_repo) AS repos
FROM long_bronze""")
def a10_counts(spark, sf):
    return I.long_bronze(spark, sf).agg(
        F.count_distinct("date").alias("dates"), F.count_distinct("keyword").alias("keywords"),
        F.count_distinct("top_repo").alias("repos"))


@check("a10_stored_bitmaps", f"""WITH d AS (SELECT {SHIP_DATES} AS date, l_partkey, l_suppkey FROM lineitem)
SELECT 'all' AS month, 'l_partkey' AS name, count(DISTINCT l_partkey) AS distinct_values FROM d
UNION ALL SELECT 'all', 'l_suppkey', count(DISTINCT l_suppkey) FROM d
UNION ALL SELECT substr(date, 1, 7), 'l_partkey', count(DISTINCT l_partkey) FROM d GROUP BY 1
UNION ALL SELECT substr(date, 1, 7), 'l_suppkey', count(DISTINCT l_suppkey) FROM d GROUP BY 1""")
def a10_bitmaps(spark, sf):
    """Bitmaps stored by date give the distinct counts of every month and of all dates; the items are read once."""
    path = scratch_path(spark, "bitmaps")
    distinct.number_bitmaps(_items(spark, sf), ["l_partkey", "l_suppkey"], "date").repartition("date").write.parquet(path)
    stored = spark.read.parquet(path)
    by_month = distinct.distinct_counts(stored.withColumn("month", F.substring("date", 1, 7)), "month")
    return by_month.unionByName(distinct.distinct_counts(stored).select(F.lit("all").alias("month"), "name", "distinct_values"))


@check("a11_bounds", f"SELECT min({SHIP_DATES}) AS earliest, max({SHIP_DATES}) AS latest FROM lineitem")
def a11(spark, sf):
    return rollups.bounds(_items(spark, sf), "date")


@check("a12_value_counts", "SELECT o_orderpriority, count(*) AS rows FROM orders GROUP BY 1")
def a12(spark, sf):
    return rollups.value_counts(I.table(spark, sf, "orders"), "o_orderpriority")


@check("a12_category_distribution", f"""WITH {I.GOLD_SQL}
SELECT technology_category, count(DISTINCT technology) AS technologies FROM gold GROUP BY 1""")
def a12_categories(spark, sf):
    """Technologies per category of a dictionary-classified name list."""
    names = I.gold(spark, sf).select("technology", "technology_category").distinct()
    return rollups.value_counts(names, "technology_category").withColumnRenamed("rows", "technologies")


@check("a13_duplicate_keys", """SELECT l_orderkey, l_linenumber, count(*) AS rows FROM lineitem
GROUP BY 1, 2 HAVING count(*) > 1""")
def a13(spark, sf):
    return quality.duplicate_keys(I.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@check("a13_excess_rows", """SELECT count(*) AS duplicate_keys, CAST(sum(n) - count(*) AS BIGINT) AS excess_rows FROM (
  SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)""")
def a13_excess(spark, sf):
    return quality.duplicate_summary(I.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@check("a14_top_sums", f"""WITH {I.LONG_BRONZE_SQL}
SELECT keyword, CAST(sum(mentions) AS BIGINT) AS total FROM long_bronze GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""")
def a14(spark, sf):
    return rollups.top_by_sum(I.long_bronze(spark, sf), "keyword", "mentions")


@check("a15_summary", """SELECT count(l_quantity) AS count, round_even(avg(l_quantity), 6) AS mean,
  round_even(stddev_samp(l_quantity), 6) AS stddev, min(l_quantity) AS min, max(l_quantity) AS max FROM lineitem""")
def a15(spark, sf):
    out = rollups.summary(I.table(spark, sf, "lineitem"), "l_quantity")
    return out.withColumn("mean", F.bround("mean", 6)).withColumn("stddev", F.bround("stddev", 6))


@check("a16_profile", """SELECT count(*) AS row_count, CAST(6 AS INTEGER) AS column_count,
  count(DISTINCT event_type) AS unique_event_type, count(DISTINCT user_id) AS unique_user_id,
  max(event_id) AS latest_event_id FROM events""")
def a16(spark, sf):
    return rollups.profile(I.table(spark, sf, "events"), ["event_type", "user_id"], ["event_id"])


@check("a17_rate", """SELECT count(*) FILTER (WHERE event_type = 'view') AS hits, count(*) AS rows,
  round_even(CAST(count(*) FILTER (WHERE event_type = 'view') AS DOUBLE) / count(*) * 100, 6) AS percent FROM events""")
def a17(spark, sf):
    out = rollups.rate(I.table(spark, sf, "events"), F.col("event_type") == "view")
    return out.withColumn("percent", F.bround("percent", 6))


@check("a19_whole_total", f"""WITH {I.GOLD_SQL}
SELECT CAST(sum(daily_mentions) AS BIGINT) AS total_mentions, count(*) AS rows FROM gold""")
def a19(spark, sf):
    return I.gold(spark, sf).agg(F.sum("daily_mentions").alias("total_mentions"), F.count("*").alias("rows"))


@check("a20_range_stats", """SELECT count(*) AS kept, CAST(sum(event_id) AS BIGINT) AS total, max(event_id) AS largest,
  CAST(sum(event_id * event_id) AS BIGINT) AS squares FROM events WHERE event_type = 'click'""")
def a20(spark, sf):
    """A sum beyond 64 bits, for which the SQL has no result, stays a decimal."""
    stats = rollups.range_stats(I.table(spark, sf, "events"), "event_id", F.col("event_type") == "click")
    return rollups.as_long(stats, "total", "squares")


# --- J: joins and gaps ---

@check("j4_missing_dates", f"""SELECT DISTINCT {SHIP_DATES} AS date FROM lineitem
EXCEPT SELECT {ORDER_DATES} FROM orders""")
def j4(spark, sf):
    return gaps.missing_dates(_items(spark, sf), _orders(spark, sf))


@check("j5_overlap", f"""SELECT {SHIP_DATES} AS date FROM lineitem INTERSECT SELECT {ORDER_DATES} FROM orders""")
def j5(spark, sf):
    """Dates that appear on both sides, as a semi join of the distinct dates."""
    return gaps.dates_of(_items(spark, sf)).join(gaps.dates_of(_orders(spark, sf)), "date", "left_semi")


@check("j6_single_member_groups", """SELECT o_orderkey, o_custkey, o_orderstatus FROM orders
WHERE o_custkey IN (SELECT o_custkey FROM orders GROUP BY 1 HAVING count(*) = 1)""")
def j6(spark, sf):
    orders = I.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return gaps.single_member_groups(orders, "o_custkey")


_UNPROCESSED = f"""WITH bounds AS (SELECT min(CAST(l_shipdate AS DATE)) AS lo, max(CAST(l_shipdate AS DATE)) AS hi FROM lineitem),
days AS (SELECT strftime(unnest(generate_series(lo::TIMESTAMP, hi::TIMESTAMP, INTERVAL 1 DAY)), '%Y-%m-%d') AS date FROM bounds)
SELECT date FROM days WHERE date NOT BETWEEN '1996-01-10' AND '1996-02-20'
  AND date NOT IN (SELECT {SHIP_DATES} FROM lineitem GROUP BY 1 HAVING count(*) > 20)"""


def _unprocessed(spark, sf):
    items = _items(spark, sf)
    lo, hi = items.agg(F.min("date").alias("d")).scalar(), items.agg(F.max("date").alias("d")).scalar()
    return gaps.unprocessed_dates(items, lo, hi, ("1996-01-10", "1996-02-20"), minimum=20)


@check("j7_unprocessed_dates", _UNPROCESSED)
def j7(spark, sf):
    return _unprocessed(spark, sf)


@check("o4_next_date", f"SELECT min(date) AS next_date FROM ({_UNPROCESSED})")
def o4(spark, sf):
    return _unprocessed(spark, sf).agg(F.min("date").alias("next_date"))


# --- O: sorts and limits ---

@check("o1_top_by_rank", """SELECT * FROM (SELECT o_orderkey,
  CAST(dense_rank() OVER (ORDER BY CAST(floor(o_totalprice) AS BIGINT) DESC) AS INTEGER) AS price_rank FROM orders)
ORDER BY price_rank, o_orderkey LIMIT 10""")
def o1(spark, sf):
    orders = I.table(spark, sf, "orders").select("o_orderkey", F.floor("o_totalprice").alias("price"))
    ranked = ranking.add_dense_ranks(orders, "price", {"price_rank": []}).drop("price")
    return ranking.top_n(ranked, ["price_rank", "o_orderkey"], 10)


@check("o2_largest", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 5")
def o2(spark, sf):
    orders = I.table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return ranking.top_n(orders, [F.desc("o_totalprice"), "o_orderkey"], 5)


@check("o3_latest_records", "SELECT event_id, event_type FROM events ORDER BY ts DESC, event_id LIMIT 10")
def o3(spark, sf):
    return ranking.top_n(I.table(spark, sf, "events"), [F.desc("ts"), "event_id"], 10).select("event_id", "event_type")


@check("o5_sample", """SELECT event_id, event_type FROM events
WHERE CAST(CAST('0x' || substr(md5('42|' || event_id), 1, 12) AS BIGINT) AS DOUBLE) / 281474976710656 < 0.1""")
def o5(spark, sf):
    """Bernoulli sample by key, spread over tasks again."""
    return sampling.spread(sampling.sample_rows(I.table(spark, sf, "events"), 0.1, ["event_id"], 42), 8).select("event_id", "event_type")


# --- U: set operations ---

@check("u1_concatenated_frames", """SELECT 'order' AS kind, count(*) AS rows FROM orders
UNION ALL SELECT 'item', count(*) FROM lineitem""")
def u1(spark, sf):
    orders = I.table(spark, sf, "orders").select(F.lit("order").alias("kind"), F.col("o_orderkey").alias("k"))
    items = I.table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("k"), F.lit("item").alias("kind"))
    return rollups.counts_by(orders.unionByName(items), "kind")


@check("u2_date_difference", f"SELECT {ORDER_DATES} AS date FROM orders EXCEPT SELECT {SHIP_DATES} FROM lineitem")
def u2(spark, sf):
    return gaps.dates_of(_orders(spark, sf)).subtract(gaps.dates_of(_items(spark, sf)))


@check("u3_date_union", f"SELECT {ORDER_DATES} AS date FROM orders UNION SELECT {SHIP_DATES} FROM lineitem")
def u3(spark, sf):
    return gaps.all_dates(_orders(spark, sf), _items(spark, sf))


@check("u4_date_intersection", f"SELECT {ORDER_DATES} AS date FROM orders INTERSECT SELECT {SHIP_DATES} FROM lineitem")
def u4(spark, sf):
    return gaps.common_dates(_orders(spark, sf), _items(spark, sf))


# --- V, X8, F4, S16, S17: checks and row versions ---

@check("v1_null_counts", """SELECT 'response_data' AS "column", count(*) FILTER (WHERE page_id % 10 IN (0, 1, 2)) AS nulls FROM pages
UNION ALL SELECT 'status_code', count(*) FILTER (WHERE page_id % 10 = 2) FROM pages
UNION ALL SELECT 'url', count(*) FILTER (WHERE url IS NULL) FROM pages""")
def v1(spark, sf):
    from ..operators.payloads import split_responses

    return quality.null_counts(split_responses(I.responses(spark, sf)), ["response_data", "status_code", "url"])


@check("v2_hour_coverage", f"""WITH {I.EVENTS_SQL},
seen AS (SELECT DISTINCT date, hour FROM ev WHERE type = 'purchase'),
days AS (SELECT DISTINCT date FROM seen),
grid AS (SELECT date, CAST(h AS INTEGER) AS hour FROM days, (SELECT unnest(generate_series(0, 23)) AS h))
SELECT g.date, CAST(count(s.hour) AS INTEGER) AS hours_present, CAST(24 - count(s.hour) AS INTEGER) AS hours_missing,
  coalesce(string_agg(CAST(CASE WHEN s.hour IS NULL THEN g.hour END AS VARCHAR), ',' ORDER BY g.hour), '') AS missing,
  24 - count(s.hour) <= 12 AS accepted
FROM grid g LEFT JOIN seen s ON g.date = s.date AND g.hour = s.hour GROUP BY g.date""")
def v2(spark, sf):
    """Hours with a purchase, per date."""
    return gaps.hour_coverage(I.matches(spark, sf).where("type = 'purchase'"))


@check("x8_retention", f"""WITH {I.EVENTS_SQL}, cut AS (SELECT max(ts) - INTERVAL 30 HOUR AS c FROM events)
SELECT date, hour, count(*) AS rows FROM ev, cut
WHERE NOT (date < strftime(c, '%Y-%m-%d') OR (date = strftime(c, '%Y-%m-%d') AND hour < extract('hour' FROM c)))
GROUP BY date, hour""")
def x8(spark, sf):
    now = I.table(spark, sf, "events").agg(F.max(F.col("ts").cast("timestamp"))).scalar()
    return rollups.counts_by(retain_hours(I.matches(spark, sf), now, 30), "date", "hour")


@check("x8_retention_report", f"""WITH {I.EVENTS_SQL}, cut AS (SELECT max(ts) - INTERVAL 30 HOUR AS c FROM events)
SELECT count(*) FILTER (WHERE old) AS removed, count(*) FILTER (WHERE NOT old) AS remaining FROM (
  SELECT date < strftime(c, '%Y-%m-%d') OR (date = strftime(c, '%Y-%m-%d') AND hour < extract('hour' FROM c)) AS old
  FROM ev, cut)""")
def x8_report(spark, sf):
    now = I.table(spark, sf, "events").agg(F.max(F.col("ts").cast("timestamp"))).scalar()
    return retention_report(I.matches(spark, sf), now, 30)


@check("f4_rows_left_by_delete", """SELECT o_orderkey, o_orderstatus FROM orders
WHERE NOT coalesce(nullif(o_orderstatus, 'P') = 'F', false)""")
def f4(spark, sf):
    """The predicate is unknown for pending orders, which therefore stay."""
    orders = I.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return without(orders, F.nullif(F.col("o_orderstatus"), F.lit("P")) == "F")


@check("s16_read_as_of", """SELECT user_id, event_id, event_type FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS place FROM events
  WHERE ts <= TIMESTAMP '2024-01-15 12:00:00') WHERE place = 1""")
def s16(spark, sf):
    log = I.table(spark, sf, "events").select("user_id", "ts", "event_id", "event_type")
    moment = F.lit("2024-01-15 12:00:00").cast(log.schema["ts"].dataType)
    return read_as_of(log, ["user_id"], "ts", moment).drop("ts")


@check("s17_verify_write", f"""SELECT count(*) FILTER (WHERE {SHIP_DATES} = '1998-06-01') AS date_records,
  count(*) AS total_records FROM lineitem""")
def s17(spark, sf):
    return verify_write(_items(spark, sf), "1998-06-01")


@check("g6_dates_exist", f"""SELECT o.date, coalesce(n, 0) AS records, coalesce(n, 0) > 0 AS present
FROM (SELECT DISTINCT {ORDER_DATES} AS date FROM orders) o
LEFT JOIN (SELECT {SHIP_DATES} AS date, count(*) AS n FROM lineitem GROUP BY 1) i ON o.date = i.date""")
def g6_dates(spark, sf):
    return dates_exist(_items(spark, sf), _orders(spark, sf))
