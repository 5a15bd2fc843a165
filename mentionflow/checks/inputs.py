"""Inputs derived from the given tables, once as DataFrames and once as SQL.

* ``events`` become keyword matches, then Bronze, Silver, Gold and trends.
* ``lineitem`` and ``part`` give daily activity over several years.
* ``documents`` become nested events of five types with their whole texts.
* ``pages`` become landed HTTP responses, ``conversations`` become threads.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import dates as D, rules as R
from ..operators.rollups import hourly_keyword_rollup, latest
from ..plans.gold import build_gold
from ..plans.silver import build_silver
from ..plans.trends import build_trends
from ..schemas import BRONZE, TIMEFRAMES, conform
from ..sources.dictionary import Dictionary
from ..sources.events import with_provenance

STAMP = "2024-03-01 00:00:00"


def stamp():
    """Fixed processing time, so results can be compared."""
    return F.lit(STAMP).cast("timestamp")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- events -> Bronze -> Silver -> Gold -> trends ---

EVENT_DICTIONARY = Dictionary.of(
    [(f"{kind}-{i}", "testing" if (kind, i) == ("error", 6) else raw) for kind, raw in (
        ("view", "language"), ("click", "database"), ("purchase", "css_framework"), ("error", "ai_model"))
     for i in range(7)])


def matches(spark, sf_dir) -> DataFrame:
    """Each event mentions one keyword (its type and a number) in one repository (its user)."""
    k = F.get_json_object("props", "$.k").cast("long")
    return table(spark, sf_dir, "events").select(
        D.day(F.col("ts")).alias("date"), F.hour("ts").alias("hour"),
        F.concat("event_type", F.lit("-"), (k % 7).cast("string")).alias("keyword"),
        F.col("user_id").cast("string").alias("repo"), F.col("event_type").alias("type"),
        F.col("event_id").alias("event_seq"))


def bronze(spark, sf_dir) -> DataFrame:
    facts = hourly_keyword_rollup(matches(spark, sf_dir))
    return conform(with_provenance(facts, F.col("date"), stamp()), BRONZE)


def silver(spark, sf_dir) -> DataFrame:
    return build_silver(bronze(spark, sf_dir), stamp())


def gold(spark, sf_dir) -> DataFrame:
    return build_gold(silver(spark, sf_dir), EVENT_DICTIONARY, stamp())


EVENTS_SQL = """
ev AS (
  SELECT strftime(ts, '%Y-%m-%d') AS date, CAST(extract('hour' FROM ts) AS INTEGER) AS hour,
    event_type || '-' || CAST(CAST(json_extract_string(props, '$.k') AS BIGINT) % 7 AS VARCHAR) AS keyword,
    CAST(user_id AS VARCHAR) AS repo, event_type AS type, event_id AS event_seq
  FROM events),
per_repo AS (
  SELECT date, hour, keyword, repo, count(*) AS repo_mentions, min(event_seq) AS first_seen
  FROM ev GROUP BY date, hour, keyword, repo),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY date, hour, keyword
                               ORDER BY repo_mentions DESC, first_seen, repo) AS place
  FROM per_repo),
hourly AS (
  SELECT hour, keyword, CAST(sum(repo_mentions) AS BIGINT) AS mentions,
    max(CASE WHEN place = 1 THEN repo END) AS top_repo,
    max(CASE WHEN place = 1 THEN repo_mentions END) AS repo_mentions, date
  FROM placed GROUP BY date, hour, keyword),
bronze AS (
  SELECT hour, keyword, mentions, top_repo, repo_mentions,
    CAST(sum(mentions) OVER (PARTITION BY date, hour) AS BIGINT) AS event_mentions, date,
    date || '-batch.json.gz' AS source_file
  FROM hourly)"""

SILVER_SQL = EVENTS_SQL + """,
daily AS (
  SELECT date, keyword AS technology, CAST(sum(mentions) AS BIGINT) AS daily_mentions,
    CAST(sum(repo_mentions) AS BIGINT) AS daily_repo_mentions,
    CAST(sum(event_mentions) AS BIGINT) AS daily_event_mentions,
    arg_min(top_repo, hour) AS primary_repository, CAST(count(hour) AS INTEGER) AS source_record_count
  FROM bronze GROUP BY date, keyword),
silver AS (
  SELECT *, least(greatest(
      CAST(daily_mentions AS DOUBLE) / max(daily_mentions) OVER (PARTITION BY date) * 50
      + CAST(source_record_count AS DOUBLE) / 24 * 30 + 20, 0), 100) AS data_quality_score
  FROM daily)"""

GOLD_SQL = SILVER_SQL + """,
gold AS (
  SELECT date, technology, daily_mentions, daily_repo_mentions, daily_event_mentions, primary_repository,
    CASE WHEN technology = 'error-6' THEN 'testing' ELSE CASE split_part(technology, '-', 1) WHEN 'view' THEN 'language' WHEN 'click' THEN 'database'
      WHEN 'purchase' THEN 'web_framework' WHEN 'error' THEN 'ai_model'
      ELSE 'development_tool' END END AS technology_category,
    CASE WHEN daily_mentions >= 1000 THEN 'high' WHEN daily_mentions >= 100 THEN 'medium'
      WHEN daily_mentions >= 10 THEN 'low' ELSE 'minimal' END AS mention_volume,
    CASE WHEN daily_mentions > 0 THEN 'complete' ELSE 'empty' END AS data_completeness
  FROM silver)"""


def trends_sql(source: str, timeframe: str) -> str:
    """CTE ``trends`` over a Gold-like CTE named ``source``, as of its latest date."""
    days = TIMEFRAMES[timeframe]
    if days is None:
        start, length = f"(SELECT min(date) FROM {source})", f"(SELECT count(DISTINCT date) FROM {source})"
        head = (f"last AS data_end_date, {start} AS data_start_date, "
                f"CAST({length} AS INTEGER) AS total_days_analyzed")
        tail = ""
    else:
        start = f"strftime(CAST(last AS DATE) - {days - 1}, '%Y-%m-%d')"
        length = str(days)
        head = f"{start} AS window_start_date, last AS window_end_date"
        tail = f", 'stable' AS trend_direction_{timeframe}"
    if timeframe == "7d":
        tail += (", CASE WHEN avg_m >= 200 THEN 'hot' WHEN avg_m >= 50 THEN 'warm' ELSE 'cool' END"
                 " AS hotness_signal_7d")
    t = timeframe
    return f"""
anchor AS (SELECT max(date) AS last FROM {source}),
agg AS (
  SELECT last, technology, technology_category, CAST(sum(daily_mentions) AS BIGINT) AS total_m,
    avg(daily_mentions) AS avg_m, max(daily_mentions) AS peak_m, count(date) AS active
  FROM {source}, anchor WHERE date <= last AND date >= {start}
  GROUP BY last, technology, technology_category),
trends AS (
  SELECT last AS analysis_date, {head}, technology, technology_category,
    total_m AS total_mentions_{t}, avg_m AS avg_daily_mentions_{t}, peak_m AS peak_day_mentions_{t},
    CAST(active AS INTEGER) AS days_with_activity_{t},
    CAST(dense_rank() OVER (ORDER BY total_m DESC) AS INTEGER) AS mention_rank_{t},
    CAST(dense_rank() OVER (PARTITION BY technology_category ORDER BY total_m DESC) AS INTEGER)
      AS category_rank_{t},
    round_even(CAST(active AS DOUBLE) / {length} * 100, 1) AS data_completeness_{t}{tail}
  FROM agg WHERE technology NOT IN ('github', 'repository', 'repo', 'commit', 'branch', 'pull',
    'push', 'clone', 'fork', 'star', 'issue', 'pr'))"""


def trends(spark, sf_dir, timeframe: str) -> DataFrame:
    """Trend table of the events' Gold as of its latest date, without the processing time."""
    last = latest(table(spark, sf_dir, "events").select(D.day(F.col("ts")).alias("date")), "date")
    return build_trends(gold(spark, sf_dir), last, timeframe, stamp()).drop("processed_at")


def long_trends(spark, sf_dir, timeframe: str) -> DataFrame:
    """The same of the long-span activity."""
    last = latest(table(spark, sf_dir, "lineitem").select(D.day(F.col("l_shipdate")).alias("date")), "date")
    return build_trends(long_gold(spark, sf_dir), last, timeframe, stamp()).drop("processed_at")


# --- lineitem + part: long spans ---

def long_bronze(spark, sf_dir) -> DataFrame:
    """Line items as hourly facts; several rows per key, several years of dates."""
    items = table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                                                    "l_shipdate")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type")
    number = F.col("l_linenumber").cast("long")
    quantity = F.col("l_quantity").cast("long")
    return (items.join(parts, F.col("l_partkey") == F.col("p_partkey"))
            .select(F.col("l_linenumber").cast("int").alias("hour"), F.col("p_name").alias("keyword"),
                    quantity.alias("mentions"), F.col("l_suppkey").cast("string").alias("top_repo"),
                    number.alias("repo_mentions"), (quantity + number).alias("event_mentions"),
                    D.day(F.col("l_shipdate")).alias("date"), F.col("p_type").alias("kind")))


def long_gold(spark, sf_dir) -> DataFrame:
    """Daily activity per part name and type."""
    return (long_bronze(spark, sf_dir).groupBy("date", "keyword", "kind")
            .agg(F.sum("mentions").alias("daily_mentions"))
            .select("date", F.col("keyword").alias("technology"), F.col("kind").alias("technology_category"),
                    "daily_mentions"))


LONG_BRONZE_SQL = """
long_bronze AS (
  SELECT CAST(l_linenumber AS INTEGER) AS hour, p_name AS keyword, CAST(l_quantity AS BIGINT) AS mentions,
    CAST(l_suppkey AS VARCHAR) AS top_repo, CAST(l_linenumber AS BIGINT) AS repo_mentions,
    CAST(l_quantity AS BIGINT) + l_linenumber AS event_mentions,
    strftime(l_shipdate, '%Y-%m-%d') AS date, p_type AS kind
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""

LONG_GOLD_SQL = LONG_BRONZE_SQL + """,
long_gold AS (
  SELECT date, keyword AS technology, kind AS technology_category,
    CAST(sum(mentions) AS BIGINT) AS daily_mentions
  FROM long_bronze GROUP BY date, keyword, kind)"""


# --- documents -> nested events ---

# Frequent words of the documents, a phrase, punctuated entries, one open-ended entry
# and longer pieces that mostly occur inside words.
TEXT_DICTIONARY = Dictionary.of([
    ("the", "language"), ("of", "database"), ("de", "web_framework"), ("and", "css_framework"),
    ("to", "ai_model"), ("der", "ai_technique"), ("que", "ml_framework"), ("that", "testing"),
    ("for", "ci_cd"), ("in", "cloud_platform"), ("en", "cloud_service"), ("is", "library"),
    ("la", "orm"), ("with", "build_tool"), ("was", "package_manager"), ("of the", "vector_database"),
    ("by-nc", "tool"), ("2.0", "platform"), ("mail2.example", "no such type"), ("by-", "nlp"),
    ("src1", "monitoring"), ("tion", "data_library"), ("ering", "blockchain")])

_DICT_VALUES = ", ".join(f"('{k}', '{t}', {i})" for i, (k, t) in enumerate(TEXT_DICTIONARY.entries))
DICT_SQL = f"\ndict(keyword, raw_type, ordinal) AS (VALUES {_DICT_VALUES})"

# (keyword, RE2 pattern of its whole-word form)
PHRASES_SQL = r"""
phrases(keyword, pattern) AS (VALUES
  ('of the', '(^|[^\p{L}\p{N}_])of the([^\p{L}\p{N}_]|$)'),
  ('by-nc', '(^|[^\p{L}\p{N}_])by-nc([^\p{L}\p{N}_]|$)'),
  ('2.0', '(^|[^\p{L}\p{N}_])2\.0([^\p{L}\p{N}_]|$)'),
  ('mail2.example', '(^|[^\p{L}\p{N}_])mail2\.example([^\p{L}\p{N}_]|$)'),
  ('by-', '(^|[^\p{L}\p{N}_])by-[\p{L}\p{N}_]'))"""


def doc_events(spark, sf_dir, frame: DataFrame | None = None) -> DataFrame:
    """Documents as events with date and hour; the type follows the document number.

    The whole text is what each type searches. The repository is named by source, language
    and first word; where it is the subject, the text is not.
    """
    d = table(spark, sf_dir, "documents") if frame is None else frame
    kind = F.col("doc_id") % 5
    lines = F.split("text", "\n")
    word = F.regexp_extract(F.lower("text"), r"([\p{L}\p{N}_]+)", 1)
    payload = F.struct(
        F.when(kind == 0, F.transform(lines, lambda x: F.struct(x.alias("message")))).alias("commits"),
        F.when(kind == 1, F.struct(
            F.col("text").alias("title"), F.col("text").alias("body"),
            F.struct(F.concat("lang", F.lit("/"), word).alias("ref")).alias("head"))).alias("pull_request"),
        F.when(kind == 2, F.col("text")).alias("description"),
        F.when(kind == 2, F.col("lang")).alias("ref"),
        F.when(kind == 3, F.struct(F.col("text").alias("name"), F.col("source").alias("tag_name"))).alias("release"),
        F.when(kind == 4, F.struct(F.col("text").alias("title"))).alias("issue"))
    kinds = ["PushEvent", "PullRequestEvent", "CreateEvent", "ReleaseEvent", "IssuesEvent"]
    return d.select(
        F.col("doc_id").cast("string").alias("id"),
        F.element_at(F.array(*[F.lit(k) for k in kinds]), (kind + 1).cast("int")).alias("type"),
        F.struct(F.col("source").alias("login")).alias("actor"),
        F.struct(F.concat("source", F.lit("/"), "lang", F.lit("-"), word).alias("name")).alias("repo"),
        payload.alias("payload"),
        F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 30).cast("int")),
                      "yyyy-MM-dd").alias("date"),
        (F.col("doc_id") % 24).cast("int").alias("hour"))


DOCS_SQL = r"""
docs AS (
  SELECT doc_id, text, lang, source, string_split(text, chr(10)) AS lines,
    regexp_extract(lower(text), '[\p{L}\p{N}_]+') AS word,
    CASE doc_id % 5 WHEN 0 THEN 'PushEvent' WHEN 1 THEN 'PullRequestEvent' WHEN 2 THEN 'CreateEvent'
      WHEN 3 THEN 'ReleaseEvent' ELSE 'IssuesEvent' END AS type,
    strftime(DATE '2024-01-01' + CAST(doc_id % 30 AS INTEGER), '%Y-%m-%d') AS date,
    CAST(doc_id % 24 AS INTEGER) AS hour
  FROM documents),
doc_ev AS (SELECT *, source || '/' || lang || '-' || word AS repo FROM docs)"""


#: CTE ``msgs``: one row per message and position.
MESSAGES_SQL = """
msg_lists AS (
  SELECT doc_id, date, hour, repo, type,
    list_filter(CASE doc_id % 5 WHEN 0 THEN list_transform(lines, lambda x: lower(x))
      WHEN 1 THEN [lower(text), lower(text)] ELSE CAST([] AS VARCHAR[]) END,
      lambda x: x IS NOT NULL AND x <> '') AS messages
  FROM doc_ev),
msgs AS (
  SELECT doc_id, date, hour, repo, type, unnest(messages) AS message,
    generate_subscripts(messages, 1) AS pos
  FROM msg_lists)"""


# Keywords per message row of a CTE ``msgs``; then the first position of each.
CAPPED_SQL = r"""
msg_hits AS (
  SELECT doc_id, pos, keyword FROM (
    SELECT DISTINCT doc_id, pos, unnest(regexp_extract_all(message, '[\p{L}\p{N}_]+')) AS keyword FROM msgs)
  WHERE keyword IN (SELECT keyword FROM dict)
  UNION ALL
  SELECT doc_id, pos, keyword FROM msgs, phrases 
  WHERE CASE WHEN contains(message, keyword) THEN regexp_matches(message, pattern) ELSE false END),
first_hits AS (SELECT doc_id, keyword, min(pos) AS pos FROM msg_hits GROUP BY doc_id, keyword),
capped AS (
  SELECT doc_id, keyword FROM (
    SELECT * FROM first_hits))"""

SEARCH_SQL = r"""
search AS (
  SELECT doc_id, date, repo, type, source, lang, lower(concat_ws(' ', repo, lang || '-' || word, type, source,
    CASE doc_id % 5
      WHEN 0 THEN nullif(array_to_string(list_filter(lines, lambda x: x <> ''), ' '), '')
      WHEN 1 THEN concat_ws(' ', nullif(text, ''), lang || '/' || word)
      WHEN 2 THEN concat_ws(' ', text, lang)
      WHEN 3 THEN concat_ws(' ', nullif(text, ''), source)
      ELSE nullif(text, '') END)) AS searchable_text
  FROM doc_ev)"""

ANY_SQL = r"""
any_hits AS (
  SELECT doc_id, keyword FROM search, dict
  WHERE list_contains(regexp_extract_all(searchable_text, '[\p{L}\p{N}_]+'), keyword)
     OR (length(keyword) > 3 AND contains(searchable_text, keyword)))"""


def inferred_sql(name: str) -> str:
    """CASE over the ordered inference words, as plain substring tests."""
    arms = [f"WHEN {' OR '.join(f"contains({name}, '{word}')" for word in words)} THEN '{category}'" for category, words in R.INFERENCE_RULES]
    return "CASE " + " ".join(arms) + " ELSE 'development_tool' END"


# --- pages -> landed responses ---

def responses(spark, sf_dir) -> DataFrame:
    """One response per page: mostly good JSON, some errors, bad bodies and timeouts."""
    case = F.col("page_id") % 10
    body = (F.when(case.isin(0, 1), F.col("html")).when(case == 2, F.lit("Request timeout"))
            .otherwise(F.to_json(F.struct("page_id", "url"))))
    status = (F.when(case == 0, 404).when(case == 2, F.lit(None).cast("int")).otherwise(200))
    source = F.element_at(F.array(F.lit("boards"), F.lit("threads"), F.lit("listings")),
                          (F.col("page_id") % 3 + 1).cast("int"))
    date = F.format_string("2024-01-%02d", F.col("page_id") % 5 + 1)
    return table(spark, sf_dir, "pages").select(
        source.alias("source_name"), date.alias("collection_date"), F.col("page_id").alias("arrival"),
        F.lit("company_jobs").alias("api_type"), "url", status.cast("int").alias("status_code"),
        body.alias("body"), F.concat(date, F.lit("T00:00:00+00:00")).alias("collected_at"))


RESPONSES_SQL = """
responses AS (
  SELECT CASE page_id % 3 WHEN 0 THEN 'boards' WHEN 1 THEN 'threads' ELSE 'listings' END AS source_name,
    '2024-01-' || lpad(CAST(page_id % 5 + 1 AS VARCHAR), 2, '0') AS collection_date, page_id AS arrival,
    'company_jobs' AS api_type, url,
    CAST(CASE page_id % 10 WHEN 0 THEN 404 WHEN 2 THEN NULL ELSE 200 END AS INTEGER) AS status_code,
    CASE WHEN page_id % 10 IN (0, 1) THEN html WHEN page_id % 10 = 2 THEN 'Request timeout'
      ELSE '{"page_id":' || page_id || ',"url":"' || url || '"}' END AS body,
    page_id % 10 AS kind
  FROM pages),
split AS (
  SELECT *, CASE WHEN kind > 2 THEN body END AS response_data,
    CASE WHEN kind = 1 THEN 'Invalid JSON response' WHEN kind IN (0, 2) THEN body END
      AS error_text
  FROM responses)"""


# --- conversations -> threads ---

def thread_items(spark, sf_dir) -> DataFrame:
    """First turns are stories (some of them hiring threads), later turns their comments."""
    c = table(spark, sf_dir, "conversations")
    last = c.groupBy("conv_id").agg(F.max("turn").alias("last_turn"))
    story = F.col("turn") == 0
    number = F.when(story, F.col("conv_id")).otherwise(1000000 + F.col("conv_id") * 1000 + F.col("turn"))
    kids = F.when(story & (F.col("last_turn") > 0), F.transform(
        F.sequence(F.lit(1), F.col("last_turn")), lambda t: 1000000 + F.col("conv_id") * 1000 + t))
    return c.join(last, "conv_id").select(
        number.alias("item_id"), F.when(story, "story").otherwise("comment").alias("type"),
        F.when(story & F.contains("text", F.lit("an")), F.concat(F.lit("Ask: Who is hiring? "), "text"))
        .otherwise(F.col("text")).alias("title"),
        F.coalesce(kids, F.array().cast("array<bigint>")).alias("kids"), "text")


def thread_users(spark, sf_dir) -> DataFrame:
    """Thirty consecutive stories belong to one user, newest first."""
    user = F.floor(F.col("conv_id") / 30)
    return (table(spark, sf_dir, "conversations").select(user.alias("user_id")).distinct()
            .select("user_id", F.sequence(F.col("user_id") * 30 + 29, F.col("user_id") * 30, F.lit(-1))
                    .alias("submitted")))


THREADS_SQL = """
items AS (
  SELECT CASE WHEN turn = 0 THEN conv_id ELSE 1000000 + conv_id * 1000 + turn END AS item_id, conv_id, turn,
    CASE WHEN turn = 0 AND contains(text, 'an') THEN 'Ask: Who is hiring? ' || text ELSE text END AS title, text
  FROM conversations),
picked AS (
  SELECT * FROM (
    SELECT conv_id // 30 AS user_id, 29 - conv_id % 30 AS pos, item_id, title,
      row_number() OVER (PARTITION BY conv_id // 30 ORDER BY conv_id DESC) AS place
    FROM items WHERE turn = 0 AND 29 - conv_id % 30 < 18 AND contains(lower(title), 'who is hiring'))
  WHERE place = 1)"""
