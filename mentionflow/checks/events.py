"""Event text and keyword matching."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import large_dictionary, matching as M
from ..sources.dictionary import Dictionary, clean_keywords, longest_keywords
from ..sources.events import to_enriched_json
from . import inputs as I
from .registry import check


def _id():
    return F.col("id").cast("long").alias("doc_id")


def _docs(spark, sf):
    return I.table(spark, sf, "documents")


@check("p1_relevant_events", f"""WITH {I.DOCS_SQL}
SELECT doc_id, type FROM doc_ev WHERE type IN ('PushEvent', 'PullRequestEvent')""")
def p1(spark, sf):
    return M.relevant_events(I.doc_events(spark, sf)).select(_id(), "type")


@check("p2_event_fields", f"""WITH {I.DOCS_SQL}
SELECT CAST(doc_id AS VARCHAR) AS event_id, CASE WHEN doc_id % 5 = 4 THEN 'unknown' ELSE type END AS event_type,
  CASE WHEN doc_id % 5 = 3 THEN 'unknown' ELSE repo END AS repo_name FROM doc_ev""")
def p2(spark, sf):
    """Some events lack a repository, some a type."""
    events = I.doc_events(spark, sf)
    event = F.struct(
        "id", F.when(F.col("type") != "IssuesEvent", F.col("type")).alias("type"),
        F.when(F.col("type") != "ReleaseEvent", F.col("repo")).alias("repo"))
    return events.select(event.alias("event")).select(*M.event_fields(F.col("event")))


def _messages(spark, sf, body_chars):
    messages = T.event_messages(F.col("type"), F.col("payload"), body_chars)
    return I.doc_events(spark, sf).select(
        _id(), F.size(messages).alias("messages"), F.array_join(messages, "|").alias("joined"))


@check("p3_event_messages", f"""WITH {I.DOCS_SQL}, {I.MESSAGES_SQL}
SELECT doc_id, CAST(len(messages) AS INTEGER) AS messages, array_to_string(messages, '|') AS joined
FROM msg_lists""")
def p3(spark, sf):
    return _messages(spark, sf, None)


@check("p3_event_messages_whole", f"""WITH {I.DOCS_SQL}, {I.MESSAGES_SQL}
SELECT doc_id, CAST(len(messages) AS INTEGER) AS messages, array_to_string(messages, '|') AS joined
FROM msg_lists""")
def p3_whole(spark, sf):
    return _messages(spark, sf, None)


@check("p4_searchable_text", f"WITH {I.DOCS_SQL}, {I.SEARCH_SQL} SELECT doc_id, searchable_text FROM search")
def p4(spark, sf):
    return M.searchable(I.doc_events(spark, sf)).select(_id(), "searchable_text")


@check("p4_searchable_text_whole", f"WITH {I.DOCS_SQL}, {I.SEARCH_SQL} SELECT doc_id, searchable_text FROM search")
def p4_whole(spark, sf):
    return M.searchable(I.doc_events(spark, sf)).select(_id(), "searchable_text")


@check("p5_with_keywords", f"""WITH {I.DOCS_SQL}, {I.DICT_SQL}, {I.SEARCH_SQL}, {I.ANY_SQL}
SELECT DISTINCT doc_id FROM any_hits""")
def p5(spark, sf):
    hits = M.match_any(M.searchable(I.doc_events(spark, sf)), "searchable_text", I.TEXT_DICTIONARY)
    return M.with_keywords(hits).select(_id())


_TOKENS = r"""toks AS (
  SELECT DISTINCT doc_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}_]+')) AS keyword FROM documents)"""


@check("m1_whole_words", f"""WITH {I.DICT_SQL}, {_TOKENS}
SELECT doc_id, keyword FROM toks WHERE keyword IN (SELECT keyword FROM dict)""")
def m1(spark, sf):
    return M.match_words(_docs(spark, sf), "text", I.TEXT_DICTIONARY, ["doc_id"])


@check("m2_phrases", f"""WITH {I.PHRASES_SQL}
SELECT doc_id, keyword FROM documents, phrases
WHERE CASE WHEN contains(lower(text), keyword) THEN regexp_matches(lower(text), pattern) ELSE false END""")
def m2(spark, sf):
    return M.match_phrases(_docs(spark, sf), "text", I.TEXT_DICTIONARY, ["doc_id"])


@check("m3_capped_keywords", f"""WITH {I.DICT_SQL}, {I.PHRASES_SQL}, line_lists AS (
  SELECT doc_id, list_filter(list_transform(string_split(text, chr(10)), lambda x: lower(x)), lambda x: x <> '')
    AS messages FROM documents),
msgs AS (SELECT doc_id, unnest(messages) AS message, generate_subscripts(messages, 1) AS pos FROM line_lists),
{I.CAPPED_SQL}
SELECT doc_id, keyword FROM capped""")
def m3(spark, sf):
    """Every document is an event whose lines are its messages."""
    lines = F.filter(F.split("text", "\n"), lambda x: x != "")
    return _docs(spark, sf).select(
        "doc_id", F.explode(T.capped_hits(lines, I.TEXT_DICTIONARY)).alias("keyword"))


@check("m3_keyword_cap", f"""WITH {I.DICT_SQL}, {I.PHRASES_SQL}, line_lists AS (
  SELECT doc_id, list_filter(list_transform(string_split(text, chr(10)), lambda x: lower(x)), lambda x: x <> '')
    AS messages FROM documents),
msgs AS (SELECT doc_id, unnest(messages) AS message, generate_subscripts(messages, 1) AS pos FROM line_lists),
{I.CAPPED_SQL},
counted AS (SELECT doc_id, pos, count(*) AS n FROM first_hits GROUP BY doc_id, pos),
before AS (SELECT doc_id, pos, coalesce(sum(n) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS found FROM counted)
SELECT doc_id, keyword FROM first_hits JOIN before USING (doc_id, pos) WHERE found <= {T.KEYWORD_CAP}""")
def m3_cap(spark, sf):
    """The live format's cap: lines after the one that brings more than ten keywords do not count."""
    lines = F.filter(F.split("text", "\n"), lambda x: x != "")
    return _docs(spark, sf).select("doc_id", F.explode(T.capped_hits(lines, I.TEXT_DICTIONARY, T.KEYWORD_CAP)).alias("keyword"))


@check("m4_any_match", f"""WITH {I.DOCS_SQL}, {I.DICT_SQL}, {I.SEARCH_SQL}, {I.ANY_SQL}
SELECT doc_id, string_agg(keyword, ',' ORDER BY keyword) AS technologies FROM any_hits GROUP BY doc_id""")
def m4(spark, sf):
    hits = M.match_any(M.searchable(I.doc_events(spark, sf)), "searchable_text", I.TEXT_DICTIONARY, matched_only=True)
    return hits.select(_id(), F.array_join("technologies", ",").alias("technologies"))


@check("m4_any_match_whole", f"""WITH {I.DOCS_SQL}, {I.DICT_SQL}, {I.SEARCH_SQL}, {I.ANY_SQL}
SELECT doc_id, string_agg(keyword, ',' ORDER BY keyword) AS technologies FROM any_hits GROUP BY doc_id""")
def m4_whole(spark, sf):
    events = M.searchable(I.doc_events(spark, sf))
    hits = M.match_any(events, "searchable_text", I.TEXT_DICTIONARY, matched_only=True)
    return hits.select(_id(), F.array_join("technologies", ",").alias("technologies"))


_WHOLE_ANY = r"""SELECT doc_id, keyword FROM documents, dict
WHERE list_contains(regexp_extract_all(lower(text), '[\p{L}\p{N}_]+'), keyword)
   OR (length(keyword) > 3 AND contains(lower(text), keyword))"""


@check("j3_substring_match", f"WITH {I.DICT_SQL} {_WHOLE_ANY}")
def j3(spark, sf):
    """The same match over whole document texts; a 4-gram probe replaces the theta join."""
    return _docs(spark, sf).select("doc_id", F.explode(T.any_hits(F.col("text"), I.TEXT_DICTIONARY)).alias("keyword"))


@check("j2_token_join", r"""WITH toks AS MATERIALIZED (
  SELECT DISTINCT doc_id, lang, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}_]+')) AS keyword FROM documents),
words AS (SELECT DISTINCT lower(word) AS keyword FROM (SELECT unnest(string_split(p_name, ' ')) AS word FROM part)
          UNION SELECT lower(c_mktsegment) FROM customer UNION SELECT keyword FROM toks WHERE lang <> 'en')
SELECT doc_id, keyword FROM toks JOIN words USING (keyword)""")
def j2(spark, sf):
    """A dictionary that grows with the data: part names, segments, words of other languages."""
    foreign = _docs(spark, sf).where("lang <> 'en'").select(F.explode(T.tokens(F.col("text"))))
    words = (I.table(spark, sf, "part").select(F.explode(F.split(F.lower("p_name"), " ")).alias("keyword"))
             .union(I.table(spark, sf, "customer").select(F.lower("c_mktsegment")))
             .union(foreign).distinct())
    return M.match_words_join(_docs(spark, sf), "text", words, ["doc_id"])


# Words of which a few are parts of repository names and the rest only substrings.
REPO_DICTIONARY = Dictionary.of([(k, "tool") for k in (
    "de en src7 src1 the der language ation tion ering src2/f es-de x-ray is la una und").split()])

_REPO_SQL = f"""WITH {I.DOCS_SQL},
rdict(keyword, ordinal) AS (VALUES {", ".join(f"('{k}', {i})" for i, k in enumerate(REPO_DICTIONARY.keywords()))}),
longest AS (SELECT *, row_number() OVER (ORDER BY length(keyword) DESC, ordinal) AS place FROM rdict),
parts AS (SELECT DISTINCT doc_id, unnest(string_split(translate(repo, '/-._', '    '), ' ')) AS keyword FROM doc_ev),
exact AS (SELECT doc_id, keyword FROM parts WHERE keyword IN (SELECT keyword FROM rdict)),
inside AS (
  SELECT doc_id, arg_min(keyword, place) AS keyword FROM doc_ev, longest
  WHERE place <= 20 AND contains(lower(repo), keyword)
    AND doc_id NOT IN (SELECT doc_id FROM exact) GROUP BY doc_id)"""


@check("m5_repo_match", f"""{_REPO_SQL}
SELECT doc_id, string_agg(keyword, ',' ORDER BY keyword) AS technologies
FROM (SELECT * FROM exact UNION ALL SELECT * FROM inside) GROUP BY doc_id""")
def m5(spark, sf):
    events = I.doc_events(spark, sf).select(_id(), F.col("repo.name").alias("repo_name"))
    hits = M.match_repo(events, "repo_name", REPO_DICTIONARY, matched_only=True)
    return hits.select("doc_id", F.array_join("technologies", ",").alias("technologies"))


_LARGE_SQL = rf"""WITH {I.DOCS_SQL},
toks AS (SELECT doc_id, lang, unnest(regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}_]+')) AS keyword FROM documents),
words AS (SELECT keyword, CAST(min(doc_id) AS INTEGER) AS ordinal FROM toks WHERE lang <> 'en' GROUP BY keyword),
named AS (SELECT doc_id, lower(repo) AS repo FROM doc_ev WHERE repo IS NOT NULL),
parts AS (SELECT DISTINCT doc_id, unnest(string_split(translate(repo, '/-._', '    '), ' ')) AS keyword FROM named),
exact AS (SELECT doc_id, keyword FROM parts WHERE keyword IN (SELECT keyword FROM words)),
rest AS (SELECT * FROM named WHERE doc_id NOT IN (SELECT doc_id FROM exact)),
best AS (
  SELECT doc_id, keyword FROM rest JOIN words ON contains(repo, keyword)
  QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY length(keyword) DESC, ordinal, keyword DESC) = 1)
SELECT * FROM exact UNION ALL SELECT * FROM best"""


@check("m5_repo_match_large", _LARGE_SQL)
def m5_large(spark, sf):
    """Names against a dictionary that grows with the data: all words of the texts in other languages."""
    words = (_docs(spark, sf).where("lang <> 'en'").select(F.col("doc_id").cast("int").alias("ordinal"), F.explode(T.tokens(F.col("text"))).alias("keyword"))
             .groupBy("keyword").agg(F.min("ordinal").alias("ordinal")))
    events = I.doc_events(spark, sf).select(_id(), F.col("repo.name").alias("repo_name"))
    return large_dictionary.match_repo(events, "repo_name", words, ["doc_id"])


@check("m6_longest_keywords", """SELECT keyword, ordinal FROM (
  SELECT p_name AS keyword, min(p_partkey) AS ordinal FROM part GROUP BY p_name)
ORDER BY length(keyword) DESC, ordinal LIMIT 20""")
def m6(spark, sf):
    names = (I.table(spark, sf, "part").groupBy(F.col("p_name").alias("keyword"))
             .agg(F.min("p_partkey").alias("ordinal")))
    return longest_keywords(names, 20)


@check("s12_clean_dictionary", """SELECT lower(trim(word)) AS keyword, min(p_partkey) AS ordinal,
  arg_min(p_type, (p_partkey, p_type)) AS raw_type
FROM (SELECT unnest(string_split(' ' || upper(p_name) || ' ', ' ')) AS word, p_partkey, p_type FROM part)
WHERE length(lower(trim(word))) >= 2 GROUP BY lower(trim(word))""")
def s12(spark, sf):
    """Words of part names, untidy on purpose: padded, upper case, empty pieces."""
    words = F.split(F.concat(F.lit(" "), F.upper("p_name"), F.lit(" ")), " ")
    raw = I.table(spark, sf, "part").select(
        F.explode(words).alias("keyword"), F.col("p_type").alias("raw_type"), F.col("p_partkey").alias("ordinal"))
    return clean_keywords(raw, 2)


@check("s7_enriched_json", f"""WITH {I.DOCS_SQL}, {I.DICT_SQL}, {I.SEARCH_SQL}, {I.ANY_SQL}
SELECT doc_id, type, repo, string_agg(keyword, ',' ORDER BY keyword) AS extracted_keywords,
  searchable_text, '2.0_enhanced' AS producer_version
FROM any_hits JOIN search USING (doc_id) GROUP BY doc_id, type, repo, searchable_text""")
def s7(spark, sf):
    """Written as JSON documents, read back by field."""
    hits = M.match_any(M.searchable(I.doc_events(spark, sf)), "searchable_text", I.TEXT_DICTIONARY, matched_only=True)
    sent = to_enriched_json(hits, ["id", "type", "actor", "repo", "payload"])
    back = F.from_json("value", "id string, type string, repo struct<name:string>, extracted_keywords array<string>,"
                                " searchable_text string, producer_version string")
    return sent.select(back.alias("e")).select(
        F.col("e.id").cast("long").alias("doc_id"), "e.type", F.col("e.repo.name").alias("repo"),
        F.array_join("e.extracted_keywords", ",").alias("extracted_keywords"), "e.searchable_text",
        "e.producer_version")


@check("a18_keyword_stats", f"""WITH {I.DOCS_SQL}, {I.DICT_SQL}, {I.SEARCH_SQL}, {I.ANY_SQL}
SELECT keyword, count(*) AS events FROM any_hits GROUP BY keyword ORDER BY events DESC, keyword LIMIT 5""")
def a18(spark, sf):
    hits = M.match_any(M.searchable(I.doc_events(spark, sf)), "searchable_text", I.TEXT_DICTIONARY, matched_only=True)
    return M.keyword_stats(hits, top=5)


@check("a8_stream_counts", f"""{_REPO_SQL}
SELECT keyword, repo AS repo_name, count(*) AS mention_count
FROM (SELECT * FROM exact UNION ALL SELECT * FROM inside) JOIN doc_ev USING (doc_id) GROUP BY keyword, repo""")
def a8(spark, sf):
    from ..operators.rollups import stream_counts

    events = I.doc_events(spark, sf).select(F.col("id").alias("event_id"), F.col("repo.name").alias("repo_name"))
    return stream_counts(M.match_repo(events, "repo_name", REPO_DICTIONARY, matched_only=True))


@check("u5_array_intersection", f"""WITH {I.DICT_SQL}, {_TOKENS}
SELECT doc_id, CAST(count(*) AS INTEGER) AS shared FROM toks WHERE keyword IN ('the', 'of', 'de', 'la', 'der', 'que')
GROUP BY doc_id""")
def u5(spark, sf):
    words = F.array(*[F.lit(w) for w in ("the", "of", "de", "la", "der", "que", "the")])
    shared = F.size(F.array_intersect(T.tokens(F.col("text")), F.array_distinct(words)))
    return _docs(spark, sf).select("doc_id", shared.alias("shared")).where("shared > 0")
