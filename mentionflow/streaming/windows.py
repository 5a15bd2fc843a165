"""Event-time windows and duplicate suppression."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def _with_watermark(df: DataFrame, time: str, lateness: str) -> DataFrame:
    """A watermark on a stream that has none on this column; a query may declare only one."""
    if not df.isStreaming or "spark.watermarkDelayMs" in df.schema[time].metadata:
        return df
    return df.withWatermark(time, lateness)


def windowed_trends(df: DataFrame, length: str = "30 seconds", slide: str | None = "3 seconds",
                    time: str = "event_timestamp", key: str = "keyword",
                    lateness: str = "1 minute") -> DataFrame:
    """Mentions per key and sliding event-time window, with window bounds.

    Rows are first counted in panes as long as a slide, one row per key and pane; windows
    are then sums of panes. So a row is touched once however many windows overlap, and the
    state holds counts of panes and windows, not of rows. ``slide`` must divide ``length``,
    as the panes would not fill a window otherwise.

    The watermark bounds the state; rows later than it are dropped by a stream. A stream
    appends a window once the watermark has passed it (chained aggregations know no other mode).
    """
    if slide is None:
        counted = _with_watermark(df, time, lateness).groupBy(F.window(time, length), key).agg(F.count("*").alias("mentions"))
    else:
        if _seconds(length) % _seconds(slide):
            raise ValueError(f"a slide of {slide} does not divide a window of {length}")
        panes = _with_watermark(df, time, lateness).groupBy(F.window(time, slide).alias("pane"), key).agg(F.count("*").alias("in_pane"))
        counted = panes.groupBy(F.window(F.window_time("pane"), length, slide), key).agg(F.sum("in_pane").alias("mentions"))
    return counted.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), key, "mentions")


def _seconds(interval: str) -> float:
    """Length of an interval of one fixed unit, such as '30 seconds'."""
    number, unit = interval.split()
    return float(number) * {"millisecond": 0.001, "second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit.lower().rstrip("s")]


def dedupe_events(df: DataFrame, key: str = "event_id", time: str = "event_timestamp",
                  lateness: str = "1 minute") -> DataFrame:
    """Each event once: within the watermark on a stream, overall on a batch frame."""
    if df.isStreaming:
        return _with_watermark(df, time, lateness).dropDuplicatesWithinWatermark([key])
    return df.dropDuplicates([key])
