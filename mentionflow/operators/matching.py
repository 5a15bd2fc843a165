"""Keyword matching over event frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import text as T
from ..functions.base import explode_if
from ..session import materialize
from ..sources.dictionary import Dictionary
from .key_filter import join_keys


def relevant_events(events: DataFrame) -> DataFrame:
    """Only pushes and pull requests carry mention text in batch."""
    return events.where(F.col("type").isin(T.MENTION_EVENT_TYPES))


def with_keywords(df: DataFrame, column: str = "technologies") -> DataFrame:
    """Events with at least one keyword, from a stored or streamed column.

    Right after matching, pass ``matched_only`` to the matching operator instead.
    """
    return df.where(F.size(column) > 0)


def event_fields(event: Column, *, unknown: str = "unknown") -> list[Column]:
    """Flat id, type and repository of a parsed event; missing values become ``unknown``."""
    def field(value: Column, name: str) -> Column:
        return F.coalesce(value, F.lit(unknown)).alias(name)
    return [field(event["id"], "event_id"), field(event["type"], "event_type"),
            field(event["repo"]["name"], "repo_name")]


def _add(df: DataFrame, column: str, hits: Column, matched_only: bool) -> DataFrame:
    """Adds keyword arrays; optionally drops rows without a keyword in the same step."""
    return df.select("*", (explode_if(hits, lambda h: F.size(h) > 0) if matched_only else hits).alias(column))


def match_events(events: DataFrame, dictionary: Dictionary, cap: int | None = None,
                 body_chars: int | None = None, matched_only: bool = False) -> DataFrame:
    """Adds ``keywords``: what an event mentions, each once; with a cap across its messages.

    Rows stay in place; no shuffle.
    """
    messages = T.event_messages(F.col("type"), F.col("payload"), body_chars)
    return _add(events, "keywords", T.capped_hits(messages, dictionary, cap), matched_only)


def match_words(df: DataFrame, text: str, dictionary: Dictionary, keys: list[str]) -> DataFrame:
    """(keys, keyword) rows: plain-word keywords that are whole tokens of ``text``."""
    return (df.select(*keys, F.explode(T.word_hits(T.tokens(F.col(text)), dictionary)).alias("keyword")))


def match_phrases(df: DataFrame, text: str, dictionary: Dictionary, keys: list[str]) -> DataFrame:
    """(keys, keyword) rows: punctuated or multi-word keywords found as whole words."""
    hits = T.phrase_hits(F.col(text), T.tokens(F.col(text)), dictionary)
    return df.select(*keys, F.explode(F.array_distinct(hits)).alias("keyword"))


def match_words_join(df: DataFrame, text: str, dictionary: DataFrame, keys: list[str]) -> DataFrame:
    """The same result for a dictionary too large for an expression.

    Tokens are made distinct per row before they leave it. The dictionary is written once
    and measured: a small one is broadcast, of a large one the words' bits are tested right
    where the tokens are made, so that hardly any token without a partner is shuffled. The
    dictionary has one row per keyword, so the join adds nothing and AQE may split a hot token.
    """
    words = materialize(dictionary.select("keyword").distinct(), "dictionary")
    found = df.select(*keys, F.explode(F.array_distinct(T.tokens(F.col(text)))).alias("keyword"))
    return join_keys(found, words, "keyword").select(*keys, "keyword")


def match_any(df: DataFrame, text: str, dictionary: Dictionary, column: str = "technologies",
              matched_only: bool = False) -> DataFrame:
    """Adds the sorted keywords that are a token or (longer ones) a substring of ``text``."""
    return _add(df, column, T.any_hits(F.col(text), dictionary), matched_only)


def match_repo(df: DataFrame, repo: str, dictionary: Dictionary, fallback: int | None = None,
               column: str = "technologies", matched_only: bool = False) -> DataFrame:
    """Adds the keywords of a repository name."""
    return _add(df, column, T.repo_hits(F.col(repo), dictionary, fallback), matched_only)


def searchable(events: DataFrame, **limits) -> DataFrame:
    """Adds ``searchable_text`` to nested events; keyword limits as in functions.text."""
    return events.select("*", T.searchable_text(
        F.col("type"), F.col("repo.name"), F.col("actor.login"), F.col("payload"), **limits
    ).alias("searchable_text"))


def keyword_stats(df: DataFrame, top: int | None = None, column: str = "technologies") -> DataFrame:
    """Number of events per keyword, most frequent first; ``top`` keeps a short report."""
    counts = (df.select(F.explode(column).alias("keyword"))
              .groupBy("keyword").agg(F.count("*").alias("events"))
              .orderBy(F.desc("events"), "keyword"))
    return counts if top is None else counts.limit(top)
