"""Events to hourly mention facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import capped_hits, event_messages
from ..operators.matching import relevant_events
from ..operators.rollups import hourly_keyword_rollup
from ..schemas import BRONZE, conform
from ..sources.dictionary import Dictionary
from ..sources.events import with_provenance


def event_matches(events: DataFrame, dictionary: Dictionary, cap: int | None = None,
                  body_chars: int | None = None) -> DataFrame:
    """One row per event and keyword: date, hour, keyword, repo, type, event_seq.

    ``events`` are nested events with date and hour. The sequence number is the numeric
    event id; ids grow with time. Keywords are exploded where they are computed, so no
    inferred filter computes them again.
    """
    hits = capped_hits(event_messages(F.col("type"), F.col("payload"), body_chars), dictionary, cap)
    return relevant_events(events).select(
        "date", "hour", F.explode(hits).alias("keyword"),
        F.coalesce("repo.name", F.lit("unknown")).alias("repo"), "type",
        F.expr("try_cast(id AS bigint)").alias("event_seq"))


def build_bronze(events: DataFrame, dictionary: Dictionary, processing_time: Column | None = None,
                 cap: int | None = None, body_chars: int | None = None) -> DataFrame:
    """Hourly facts of all dates in the input.

    Matching is map-side. The first shuffle moves one row per (date, hour, keyword,
    repository) and map task, the later ones less.
    """
    facts = hourly_keyword_rollup(event_matches(events, dictionary, cap, body_chars))
    return conform(with_provenance(facts, F.col("date"), processing_time), BRONZE)
