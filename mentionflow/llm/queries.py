"""The operators as queries over the given tables, and SQL that must agree where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import materialize
from . import (chat, decontaminate, fingerprints, hard_negatives, html_wrappers, licenses, merkle, mixing, ngram_join, packing,
               toxicity, url_graph, warc)
from .common import bounded, table

# --- 1: benchmark decontamination ---

def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
                        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


OP1_SQL = r"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
iw AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
wins AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS k, array_to_string(w[s:s + least(10, len(w)) - 1], ' ') AS g
  FROM iw, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS t(s) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT k FROM wins),
occ AS (
  SELECT d.doc_id, s.k, p, array_to_string(d.w[p:p + s.k - 1], ' ') AS g
  FROM dw d, sizes s, unnest(range(1, len(d.w) - s.k + 2)) AS t(p)),
hit AS (SELECT o.doc_id, w.item_id, o.p, o.k FROM occ o JOIN wins w ON w.k = o.k AND w.g = o.g),
marked AS (SELECT doc_id, count(DISTINCT p + i) AS n_hit FROM hit, unnest(range(0, k)) AS u(i) GROUP BY doc_id),
listed AS (
  SELECT doc_id, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS items
  FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(m.n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(l.n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(l.items, '')) AS items_sha256, coalesce(m.n_hit, 0) > 0 AS contaminated
FROM dw d LEFT JOIN marked m ON m.doc_id = d.doc_id LEFT JOIN listed l ON l.doc_id = d.doc_id
"""

# --- 7: mixing ---

MIX_WEIGHTS = [5.0, 2.0, 1.0]


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    mixed = mixing.mix(docs, mixing.word_count(F.col("text")), MIX_WEIGHTS)
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


OP7_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS key
  FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight
  FROM sized GROUP BY source),
levels AS (  -- with the sources before k stopped at their caps, the level that shares the rest by weight
  SELECT 2.0 * source_size / weight AS stops,
         (1.5 * (SELECT sum(source_size) FROM sources)
          - coalesce(sum(2.0 * source_size) OVER (ORDER BY 2.0 * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(weight) OVER (ORDER BY 2.0 * source_size / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM sources),
flood AS (SELECT max(level) AS level FROM levels WHERE level < stops),
targets AS (
  SELECT source, source_size, CAST(least(2.0 * source_size, coalesce(level, 0) * weight) AS DOUBLE) AS target FROM sources, flood),
cut AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target) AS BIGINT) // source_size ELSE 0 END AS epochs FROM targets),
placed AS (
  SELECT s.doc_id, s.size, c.source_size, c.target, c.epochs, CAST(floor(c.target) AS BIGINT) - c.epochs * c.source_size AS rest,
         sum(s.size) OVER (PARTITION BY s.source ORDER BY s.key, s.doc_id, s.size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - s.size AS start
  FROM sized s JOIN cut c ON s.source IS NOT DISTINCT FROM c.source)
SELECT doc_id, size, source_size, target, CAST(epochs * size + greatest(0, least(size, rest - start)) AS BIGINT) AS taken FROM placed
"""

# --- 9: url filter ---

URL_RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/")]


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return url_graph.filter_urls(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def _rank_sql(name: str, seeds: str, src: str, dst: str) -> str:
    """Personalised PageRank as a chain of steps."""
    step = lambda k: f"""
{name}{k} AS (
  SELECT host, sum(rank) AS rank FROM (
    SELECT host, 0.15::DOUBLE * weight AS rank FROM {seeds}
    UNION ALL SELECT e.{dst}, 0.85::DOUBLE * r.rank * e.links / o.total
      FROM {name}{k - 1} r JOIN edges e ON e.{src} = r.host JOIN (SELECT {src} AS host, sum(links) AS total FROM edges GROUP BY 1) o ON o.host = r.host
    UNION ALL SELECT host, 0.85::DOUBLE * rank FROM {name}{k - 1} WHERE host NOT IN (SELECT {src} FROM edges))
  GROUP BY host)"""  # noqa: E731
    return f"{name}0 AS (SELECT host, weight::DOUBLE AS rank FROM {seeds})," + ",".join(step(k) for k in range(1, url_graph.ITERATIONS + 1))


OP9_SQL = r"""
WITH RECURSIVE cut AS (
  SELECT page_id, html, CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest FROM pages),
named AS (
  SELECT page_id, html, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
rules(verdict, rule, of, start) AS (VALUES
  ('allow', 'com/', 'com', '/'), ('block', 'example.com/en/', 'example.com', '/en/'), ('allow', 'www.example.com/en/', 'www.example.com', '/en/'),
  ('block', 'net/es/', 'net', '/es/'), ('block', 'net/fr/', 'net', '/fr/')),
fitting AS (
  SELECT n.page_id, arg_max(r.rule, length(r.rule)) AS rule, arg_max(r.verdict, length(r.rule)) AS verdict
  FROM named n JOIN rules r ON (n.host = r.of OR ends_with(n.host, '.' || r.of)) AND starts_with(n.path, r.start) GROUP BY n.page_id),
judged AS (SELECT n.page_id, n.host, n.path, f.rule, f.verdict FROM named n LEFT JOIN fitting f USING (page_id)),
links AS (
  SELECT DISTINCT page_id, host AS src, translate(regexp_replace(regexp_replace(
    unnest(regexp_extract_all(html, '(?i)<a\s(?:[^>]*?\s)?href\s*=\s*["'']?(?:https?:)?//([^/?#"''\s>\\]+)', 1)), '^.*@', ''), ':[0-9]*$', ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS dst FROM named),
edges AS (SELECT src, dst, count(*) AS links FROM links WHERE src <> '' AND dst <> '' AND src <> dst GROUP BY 1, 2),
hosts AS (
  SELECT host, count(*) AS pages, count(*) FILTER (verdict = 'allow') AS allowed, count(*) FILTER (verdict = 'block') AS blocked FROM judged GROUP BY host),
good AS (SELECT host, allowed AS weight FROM hosts WHERE allowed > 0 AND host <> ''),
bad AS (SELECT host, blocked AS weight FROM hosts WHERE blocked > 0 AND host <> ''),
TRUST,
DISTRUST,
scores AS (
  SELECT h.host, CASE WHEN coalesce(d.rank, 0) > coalesce(t.rank, 0) + 0.5 * h.pages THEN 'block' ELSE 'allow' END AS verdict
  FROM hosts h LEFT JOIN trustN t ON t.host = h.host LEFT JOIN distrustN d ON d.host = h.host)
SELECT j.page_id, j.host, j.path, j.rule, coalesce(j.verdict, s.verdict) AS verdict FROM judged j JOIN scores s ON s.host = j.host
""".replace("DISTRUST,", _rank_sql("distrust", "bad", "dst", "src") + ",").replace("TRUST,", _rank_sql("trust", "good", "src", "dst") + ",") \
   .replace("trustN", f"trust{url_graph.ITERATIONS}")

# --- 5: WARC ---

def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = warc.archive(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return index.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "urlkey")


OP5_SQL = """
WITH digested AS (
  SELECT page_id, url, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages),
based AS (
  SELECT *, list_aggregate(list_transform(range(0, 32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    CAST((CAST('0x' || substr(hex, CAST(5 * (k // 4) + 1 AS INT), 5) AS BIGINT) >> CAST(15 - 5 * (k % 4) AS INT)) & 31 AS INT) + 1, 1)), 'string_agg', '') AS payload_digest
  FROM digested),
kept AS (SELECT *, max(page_id) OVER (PARTITION BY hex, payload_bytes) AS kept FROM based),
cut AS (SELECT *, CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest FROM kept)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN page_id < kept THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id < kept THEN kept END AS refers_to,
       list_aggregate(list_reverse(string_split(translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '.')), 'string_agg', ',')
       || ')' || translate(regexp_replace(rest, '^[^/?#]*', ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS urlkey
FROM cut
"""

# --- 6: fingerprints ---

def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_edited(table(spark, sf_dir, "documents").select("doc_id", "text"))


# --- 8: licences ---

def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.recognise(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.array_join("sentence_ids", ",").alias("sentence_ids"), F.array_join("licenses", ",").alias("licenses"))


def _values(rows) -> str:
    return ", ".join("(" + ", ".join(str(v) if isinstance(v, int) else "'" + v.replace("'", "''") + "'" for v in row) + ")" for row in rows)


OP8_SQL = f"""
WITH plain(sentence_id, sentence) AS (VALUES {_values(licenses.SENTENCES.items())}),
rules(license, ids) AS (VALUES {_values((name, ',' + ','.join(map(str, ids)) + ',') for name, ids in licenses.RULES)}),
cut AS (
  SELECT doc_id, 'wrapped' AS cut, regexp_split_to_array(text, '[.!?]+(?:[ \\t\\n\\r\\f\\v]+|$)|\\n[ \\t\\r]*\\n') AS sentences FROM documents
  UNION ALL SELECT doc_id, 'lines', regexp_split_to_array(text, '[.!?]+(?:[ \\t\\n\\r\\f\\v]+|$)|\\n+') FROM documents),
pieces AS (SELECT doc_id, cut, unnest(sentences) AS sentence, generate_subscripts(sentences, 1) AS place FROM cut),
clean AS (
  SELECT doc_id, cut, place, trim(regexp_replace(translate(sentence, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^0-9a-z\\x80-\\x{{10FFFF}}]+', ' ', 'g')) AS known FROM pieces),
known AS (
  SELECT sentence_id, trim(regexp_replace(translate(sentence, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^0-9a-z\\x80-\\x{{10FFFF}}]+', ' ', 'g')) AS known FROM plain),
sequences AS (
  SELECT doc_id, cut, string_agg(CAST(sentence_id AS VARCHAR), ',' ORDER BY place) AS ids FROM clean JOIN known USING (known) GROUP BY doc_id, cut),
held AS (
  SELECT doc_id, string_agg(license, ',' ORDER BY license) AS licenses
  FROM (SELECT DISTINCT s.doc_id, r.license FROM sequences s JOIN rules r ON contains(',' || s.ids || ',', r.ids)) GROUP BY doc_id)
SELECT d.doc_id, coalesce(s.ids, '') AS sentence_ids, coalesce(h.licenses, '') AS licenses
FROM documents d LEFT JOIN sequences s ON s.doc_id = d.doc_id AND s.cut = 'lines' LEFT JOIN held h ON h.doc_id = d.doc_id
"""

# --- 10: HTML extraction ---

def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_wrappers.extract(table(spark, sf_dir, "pages"))


# --- 2: chat formatting ---

#: What speakers are called in the transcripts that are made of the conversations.
SPEAKERS = [("System: ", "User: ", "Assistant: "), ("[system] ", "Human: ", "AI: "), ("### Instructions:", "### Question: ", "### Answer: "), ("", "", "")]


def transcripts(conversations: DataFrame) -> DataFrame:
    """Conversations as transcripts: a style of markers each, every fourth turn without its marker."""
    styles = F.array(*[F.array(*map(F.lit, names)) for names in SPEAKERS])
    draw = lambda *columns: F.pmod(F.xxhash64(*columns), F.lit(4)).cast("int")
    names = F.element_at(styles, draw("conv_id") + 1)
    role = F.array_position(F.array(*map(F.lit, chat.ROLES)), F.col("role")).cast("int")
    marker = F.when((role > 0) & (draw("conv_id", "turn") > 0), F.element_at(names, role)).otherwise("")
    return conversations.select("conv_id", "turn", "role", F.concat(marker, F.coalesce("text", F.lit(""))).alias("text"))


def op2_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Roles of the lines of all transcripts by a model of four fifths of the conversations; ``role`` is the true one."""
    pieces = transcripts(table(spark, sf_dir, "conversations"))
    known = pieces.where(F.crc32(F.col("conv_id").cast("string")) % 5 != 0)
    model = chat.train(chat.transcript_lines(known, ["role"]))
    return chat.parse(pieces, model, ["role"])


# --- 3: toxicity ---

def held_out():
    """Rows whose labels are never learned from."""
    return F.crc32(F.col("doc_id").cast("string")) % 5 == 0


def toxicity_model(docs: DataFrame, labels: DataFrame) -> toxicity.Model:
    """Model from the labelled documents that are not held out; a document with both labels counts for each."""
    labels = bounded(labels.where(~held_out()).select("doc_id", "toxic"))
    return toxicity.train(docs.select("doc_id", "text").join(labels, "doc_id"), key="doc_id")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity_model(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select("doc_id", held_out().alias("held_out"), "score", "predicted")


# --- 4: n-gram Jaccard join ---

def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ngram_join.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_shingles", "class_id", "component_id")


# --- 11: packing ---

def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    pieces = packing.token_pieces(table(spark, sf_dir, "documents").select("doc_id", "text"), public_tokenizers.path("byte_bpe_50k.json"))
    return packing.pack(pieces).drop("salt")


# --- 12: Merkle manifest ---

LEAF_FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Proofs of all documents, and whether what a reader received still leads to the root."""
    docs = table(spark, sf_dir, "documents").select(*LEAF_FIELDS)
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    received = merkle.leaf_hash([*map(F.col, LEAF_FIELDS[:-1]), tampered])
    proved = merkle.manifest(docs, LEAF_FIELDS, received=merkle.hexed(received))
    folded = proved.withColumn("folded_root", merkle.folded(F.col("received"), F.col("proof")))
    return folded.select("doc_id", "leaf", "subroot", "root", merkle.proof_hash(F.col("proof")).alias("proof_sha256"), "folded_root",
                         (F.col("folded_root") == F.col("root")).alias("verified"))


def _leaf_sql(text: str) -> str:
    part = lambda c: f"coalesce(CAST(octet_length(encode(CAST({c} AS VARCHAR))) AS VARCHAR) || ':' || CAST({c} AS VARCHAR), '-')"
    return "sha256(" + " || ".join(part(c) for c in [*LEAF_FIELDS[:-1], text]) + ")"


def _tree_sql(name: str, leaves: str) -> str:
    """All nodes of the trees over ``leaves`` (tree, pos, digest, n): level by level, runs of three."""
    return f"""
{name}(tree, level, pos, digest, n) AS (
  SELECT tree, 0, CAST(pos AS BIGINT), digest, CAST(n AS BIGINT) FROM {leaves}
  UNION ALL SELECT tree, level + 1, pos // 3, sha256(string_agg(digest, '' ORDER BY pos)), (n + 2) // 3
  FROM {name} WHERE n > 1 GROUP BY tree, level, pos // 3, n)"""


def _siblings_sql(name: str) -> str:
    """The siblings of every node below its tree's root."""
    return f"""
{name}_siblings AS (
  SELECT a.tree, a.level, a.pos, coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS l,
         coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS r
  FROM {name} a JOIN {name} b ON a.tree = b.tree AND a.level = b.level AND a.pos // 3 = b.pos // 3
  WHERE a.n > 1 GROUP BY a.tree, a.level, a.pos)"""


OP12_SQL = f"""
WITH RECURSIVE bits(byte, k, c) AS (
  SELECT range, 0, range FROM range(0, 256)
  UNION ALL SELECT byte, k + 1, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM bits WHERE k < 8),
crc_table AS (SELECT list(c ORDER BY byte) AS t FROM bits WHERE k = 8),
crc(doc_id, rest, c) AS (
  SELECT DISTINCT doc_id, CAST(doc_id AS VARCHAR), CAST(4294967295 AS BIGINT) FROM documents WHERE doc_id IS NOT NULL
  UNION ALL SELECT doc_id, substr(rest, 2), xor(c >> 8, t[1 + (xor(c, CAST(ascii(rest) AS BIGINT)) & 255)]) FROM crc, crc_table WHERE rest <> ''),
odd AS (SELECT doc_id AS odd_id, xor(c, 4294967295) % 2 = 0 AS tampered FROM crc WHERE rest = ''),
hashed AS (
  SELECT d.doc_id, source, {_leaf_sql('text')} AS leaf, {_leaf_sql("CASE WHEN tampered THEN replace(text, chr(10), '') ELSE text END")} AS received
  FROM documents d LEFT JOIN odd o ON o.odd_id = d.doc_id),
sources AS (SELECT source, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS tree, n FROM (SELECT source, count(*) AS n FROM hashed GROUP BY source)),
rows AS (
  SELECT h.*, s.tree, s.n, row_number() OVER (PARTITION BY s.tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos
  FROM hashed h JOIN sources s ON h.source IS NOT DISTINCT FROM s.source),
leaves AS (SELECT tree, pos, leaf AS digest, n FROM rows),{_tree_sql('low', 'leaves')},
subroots AS (SELECT tree, digest FROM low WHERE n = 1),
tops AS (SELECT -1 AS tree, tree AS pos, digest, (SELECT count(*) FROM sources) AS n FROM subroots),{_tree_sql('high', 'tops')},{_siblings_sql('low')},{_siblings_sql('high')},
steps AS (
  SELECT r.tree, r.pos, s.level, s.l, s.r FROM rows r JOIN low_siblings s ON s.tree = r.tree AND s.pos = r.pos // CAST(pow(3, s.level) AS BIGINT)
  UNION ALL SELECT r.tree, r.pos, 1000 + s.level, s.l, s.r FROM rows r JOIN high_siblings s ON s.pos = r.tree // CAST(pow(3, s.level) AS BIGINT)),
proved AS (SELECT tree, pos, string_agg(l || r, '' ORDER BY level) AS proof, list([l, r] ORDER BY level) AS path FROM steps GROUP BY tree, pos),
fold(tree, pos, node, path) AS (
  SELECT r.tree, r.pos, received, coalesce(path, []) FROM rows r LEFT JOIN proved p ON p.tree = r.tree AND p.pos = r.pos
  UNION ALL SELECT tree, pos, sha256(path[1][1] || node || path[1][2]), path[2:] FROM fold WHERE len(path) > 0),
root AS (SELECT digest AS root FROM high WHERE n = 1)
SELECT r.doc_id, r.leaf, s.digest AS subroot, root, sha256(coalesce(p.proof, '')) AS proof_sha256, f.node AS folded_root, f.node = root AS verified
FROM rows r JOIN subroots s ON s.tree = r.tree JOIN fold f ON f.tree = r.tree AND f.pos = r.pos AND len(f.path) = 0
LEFT JOIN proved p ON p.tree = r.tree AND p.pos = r.pos, root
"""

# --- 13: hard negatives ---

def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).alias("label"))
    return hard_negatives.hard_negatives(rows)


OP13_SQL = """
WITH valid AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM valid a JOIN valid b ON a.vec_id % 100 = 0 AND b.vec_id <> a.vec_id AND len(b.v) = len(a.v)),
near AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
         QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.vec_id) AS INTEGER) AS rank,
       n.vec_id AS negative_id, p.positive_score, n.score AS negative_score
FROM near p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same AND 30 * p.positive_score <= 100 * n.score AND 100 * n.score <= 90 * p.positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.vec_id) <= 10
"""

QUERIES = {"op2_chat_formatting": op2_chat_formatting, "op8_licenses": op8_licenses, "op1_decontamination": op1_decontamination, "op4_ngram_join": op4_ngram_join, "op3_toxicity": op3_toxicity, "op10_html_extraction": op10_html_extraction, "op6_fingerprints": op6_fingerprints, "op5_warc": op5_warc, "op7_mixing": op7_mixing, "op9_url_filter": op9_url_filter,
           "op11_packing": op11_packing, "op12_merkle": op12_merkle, "op13_hard_negatives": op13_hard_negatives}
SQL = {"op8_licenses": OP8_SQL, "op1_decontamination": OP1_SQL, "op5_warc": OP5_SQL, "op7_mixing": OP7_SQL, "op9_url_filter": OP9_SQL,
       "op12_merkle": OP12_SQL, "op13_hard_negatives": OP13_SQL}
