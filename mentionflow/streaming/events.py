"""Event streams: enrich, parse, match. Stateless, so they also run on a batch frame."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import text as T
from ..operators.matching import event_fields, match_any, searchable
from ..schemas import EVENT
from ..sources.dictionary import Dictionary
from ..sources.events import parse_events, to_enriched_json


def event_stream(raw: DataFrame, dictionary: Dictionary) -> DataFrame:
    """Raw JSON rows to event_id, event_type, repo_name, technologies, processing_time.

    A row that is no event keeps its place with unknown fields and no technologies.
    """
    event = F.from_json(F.col("value"), EVENT)
    parsed = raw.select(event.alias("event"))
    return parsed.select(
        *event_fields(F.col("event")),
        T.repo_hits(F.col("event.repo.name"), dictionary).alias("technologies"),
        F.current_timestamp().alias("processing_time"))


def enrich_stream(raw: DataFrame, dictionary: Dictionary) -> DataFrame:
    """Events that mention a keyword anywhere, as enriched JSON ready for the topic."""
    events = searchable(parse_events(raw))
    kept = match_any(events, "searchable_text", dictionary, matched_only=True)
    return to_enriched_json(kept, EVENT.fieldNames())
