"""Benchmark decontamination by a positional inverted index.

The index stores a posting (term, document, position) for every word of the training texts
that some item uses. An item's windows are looked up from their rarest terms: the postings
of those are shifted by the terms' places in the item, and where the shifted lists meet,
the item may lie at that offset in the document. Only there the postings of all its terms
are asked for, which gives the exact windows, or, for proximity, the terms within a span.

Only DataFrame functions are used; all lists are rows, so a frequent term or a document
with many passages is never gathered in one place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import materialize
from .common import lower_ascii

#: What lies between words: ASCII other than letters and digits.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Words in a window; a shorter item is one window.
WINDOW = 10
#: Rarest terms of a window whose lists are intersected first.
SEEDS = 3


def words(text: Column) -> Column:
    """Words of a text, A to Z in lower case; none for NULL."""
    return F.filter(F.split(lower_ascii(F.coalesce(text, F.lit(""))), SEPARATORS), lambda w: w != "")


def item_terms(items: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """``item``, ``place``, ``word`` and ``size`` (words of the item) of every item word; rows of one id are one item each."""
    rows = items.select(F.col(item_id).alias("item_id"), words(F.col(text)).alias("words")).where(F.size("words") > 0)
    rows = rows.select(F.xxhash64(F.to_json(F.struct("item_id", "words"))).alias("item"), "item_id", "words").dropDuplicates(["item"])
    return rows.select("item", "item_id", F.size("words").alias("size"), F.posexplode("words").alias("place", "word"))


def build_index(docs: DataFrame, terms: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Postings ``term``, ``doc_id``, ``place`` of the given terms (``term``, ``word``), in term order within files.

    Spark broadcasts the terms if their file is small enough for it and shuffles otherwise.
    """
    found = docs.select(F.col(doc_id).alias("doc_id"), F.posexplode(words(F.col(text))).alias("place", "word"))
    return found.join(terms, "word").select("term", "doc_id", "place").sortWithinPartitions("term")


def seeds(terms: DataFrame, frequency: DataFrame, window: int = WINDOW, count: int = SEEDS) -> DataFrame:
    """The ``count`` rarest terms of every window: ``group``, ``item``, ``term``, ``place``, ``needed``.

    Windows with the same rarest places are one group; ``needed`` is their number.
    """
    ranked = terms.join(frequency, "term", "left").withColumn("frequency", F.coalesce("frequency", F.lit(0)))
    starts = F.sequence(F.greatest(F.lit(0), F.col("place") - window + 1), F.greatest(F.lit(0), F.least(F.col("place"), F.col("size") - window)))
    spread = ranked.select("item", "term", "place", "frequency", F.explode(starts).alias("start"))
    rarest = (spread.groupBy("item", "start").agg(F.slice(F.sort_array(F.collect_list(F.struct("frequency", "place", "term"))), 1, count).alias("rarest"))
              .select("item", F.sort_array(F.transform("rarest", lambda r: F.struct(r.place.alias("place"), r.term.alias("term")))).alias("rarest"))
              .distinct())
    return (rarest.select("item", F.xxhash64("item", F.to_json("rarest")).alias("group"), F.size("rarest").alias("needed"), F.explode("rarest").alias("r"))
            .select("group", "item", "needed", "r.term", "r.place"))


def offsets(index: DataFrame, seeded: DataFrame) -> DataFrame:
    """Distinct ``item``, ``doc_id``, ``offset`` where the shifted lists of all seeds of a window meet."""
    shifted = index.join(seeded.withColumnRenamed("place", "item_place"), "term").select(
        "group", "item", "needed", "doc_id", "item_place", (F.col("place") - F.col("item_place")).alias("offset"))
    met = (shifted.groupBy("group", "item", "needed", "doc_id", "offset").agg(F.size(F.collect_set("item_place")).alias("n"))
           .where(F.col("n") == F.col("needed")))
    return met.select("item", "doc_id", "offset").distinct()


def matched_words(index: DataFrame, terms: DataFrame, met: DataFrame) -> DataFrame:
    """``item``, ``doc_id``, ``offset``, ``place`` (in the item), ``size`` of the item words found at the offsets."""
    documents = materialize(met.select("doc_id").distinct(), "met-documents")
    expected = materialize(met.join(terms, "item").select("item", "size", "doc_id", "offset", "place", "term"), "expected-words")
    there = index.join(documents, "doc_id", "left_semi").withColumnRenamed("place", "at")
    return (expected.withColumn("at", F.col("offset") + F.col("place")).join(there, ["doc_id", "at", "term"])
            .select("item", "doc_id", "offset", "place", "size").distinct())


def phrase_hits(docs: DataFrame, items: DataFrame, window: int = WINDOW, doc_id: str = "doc_id", text: str = "text",
                item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """Exact matches: ``doc_id``, ``item_id``, ``at`` (place of a document word in some occurrence of a window), distinct.

    Rows with one id are one document to the index, so equal rows have equal hits. A row
    without id has no postings; NULL texts have no words.
    """
    terms, index = _indexed(docs, items, doc_id, text, item_id, item_text)
    frequency = materialize(index.groupBy("term").agg(F.count("*").alias("frequency")), "frequency")
    seeded = materialize(seeds(terms, frequency, window), "seeds")
    met = materialize(offsets(index, seeded), "offsets")
    found = matched_words(index, terms, met)
    # a window lies where all its places are found: the run of found places around it is long enough
    line = Window.partitionBy("item", "doc_id", "offset").orderBy("place")
    runs = (found.withColumn("run", F.col("place") - F.row_number().over(line))
            .groupBy("item", "doc_id", "offset", "run", "size").agg(F.min("place").alias("first"), F.count("*").alias("length"))
            .where(F.col("length") >= F.least(F.lit(window), F.col("size"))))
    names = terms.select("item", "item_id").distinct()
    return (runs.join(names, "item")
            .select("doc_id", "item_id", F.explode(F.sequence(F.col("offset") + F.col("first"), F.col("offset") + F.col("first") + F.col("length") - 1)).alias("at"))
            .distinct())


def proximity_hits(docs: DataFrame, items: DataFrame, slack: int, doc_id: str = "doc_id", text: str = "text",
                   item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """Items whose words all lie near one place: ``doc_id``, ``item_id``, ``start``, one row a match.

    Matches are looked for around the occurrences of the item's rarest term: at a ``start``
    every word of the item, the rarest one too, occurs within ``slack`` places of where it
    would lie from there. The order of the words may differ by the slack, and one document
    word may stand for two equal words of the item. An occurrence gives the start nearest to
    its own offset, the smaller of two; an exact match gives its own. With a slack of 0
    these are the exact matches.

    NULL and empty texts, items without words and rows without id have no matches; equal items
    and rows of one id count once; empty tables give no rows. Other columns are not used.
    Words are looked for in buckets of twice the slack, so a frequent term of a long text
    meets its neighbourhood only.
    """
    terms, index = _indexed(docs, items, doc_id, text, item_id, item_text)
    frequency = materialize(index.groupBy("term").agg(F.count("*").alias("frequency")), "frequency")
    rarest = (terms.join(frequency, "term").groupBy("item").agg(F.min(F.struct("frequency", "place", "term")).alias("first"))
              .select("item", F.col("first.term").alias("term"), F.col("first.place").alias("item_place")))
    starts = index.where("doc_id IS NOT NULL").join(rarest, "term").select("item", "doc_id", (F.col("place") - F.col("item_place")).alias("seed")).distinct()
    starts = materialize(starts.withColumn("start", F.explode(F.sequence(F.col("seed") - slack, F.col("seed") + slack))), "proximity-starts")
    span = 2 * slack + 1
    target = F.col("start") + F.col("place")
    expected = starts.join(terms, "item").select("item", "size", "doc_id", "seed", "start", "place", "term", target.alias("target"), F.explode(F.array_distinct(F.array(
        F.floor((target - slack) / span), F.floor((target + slack) / span)))).alias("bucket"))
    there = index.join(materialize(starts.select("doc_id").distinct(), "proximity-documents"), "doc_id", "left_semi").select(
        "doc_id", "term", F.col("place").alias("at"), F.floor(F.col("place") / span).alias("bucket"))
    near = expected.join(there, ["doc_id", "term", "bucket"]).where(F.abs(F.col("at") - F.col("target")) <= slack)
    met = (near.select("item", "size", "doc_id", "seed", "start", "place").distinct().groupBy("item", "size", "doc_id", "seed", "start").agg(F.count("*").alias("n"))
           .where(F.col("n") == F.col("size")))
    met = met.groupBy("item", "doc_id", "seed").agg(F.min_by("start", F.struct(F.abs(F.col("start") - F.col("seed")), "start")).alias("start")).drop("seed").distinct()
    return met.join(terms.select("item", "item_id").distinct(), "item").select("doc_id", "item_id", "start")


def _indexed(docs, items, doc_id, text, item_id, item_text) -> tuple[DataFrame, DataFrame]:
    """Item words with their terms, and the postings of those terms."""
    terms = materialize(item_terms(items, item_id, item_text).withColumn("term", F.xxhash64("word")), "item-terms")
    distinct = materialize(terms.select("term", "word").distinct(), "terms")
    return terms.drop("word"), materialize(build_index(docs, distinct, doc_id, text), "postings")


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, doc_id: str = "doc_id", text: str = "text",
                  item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """``doc_id``, ``n_words``, ``n_hit``, ``item_ids`` (sorted as strings) of every document.

    Texts without words (NULL, empty) and rows without id have no hits. Rows with one id
    share their hits. No items, no hits; an item without id marks words but is in no list;
    an empty table gives no rows. Other columns are not used.
    """
    hits = phrase_hits(docs, items, window, doc_id, text, item_id, item_text)
    per_item = hits.groupBy("doc_id", "item_id").agg(F.collect_set("at").alias("places"))
    counted = materialize(per_item.groupBy("doc_id").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("places")))).cast("long").alias("hit"),
        F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items")), "hits")
    counted = counted.withColumnRenamed("doc_id", "hit_id")
    own = docs.select(F.col(doc_id).alias("own_id"), F.col(text).alias("own_text"))
    return own.join(counted, F.col("own_id") == F.col("hit_id"), "left").select(
        F.col("own_id").alias(doc_id), F.size(words(F.col("own_text"))).cast("long").alias("n_words"),
        F.coalesce("hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("item_ids"))
