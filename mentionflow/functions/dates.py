"""Date and file-name expressions. Dates are 'yyyy-MM-dd' strings throughout."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def day(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd")


def minute_bucket(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm")


def shift(date: Column, days: int) -> Column:
    return F.date_format(F.date_add(date.cast("date"), days), "yyyy-MM-dd")


def window_start(analysis_date: Column, days: int) -> Column:
    """First day of a trailing window that ends on (and includes) the analysis date."""
    return shift(analysis_date, 1 - days)


def in_window(date: Column, analysis_date: Column, days: int | None) -> Column:
    """Trailing window test; ``days=None`` is everything up to the analysis date."""
    upto = date <= analysis_date
    return upto if days is None else upto & (date >= window_start(analysis_date, days))


def file_date(path: Column) -> Column:
    """Date inside a file name; NULL when there is none or it is no real date."""
    text = F.regexp_extract(path, r"(\d{4}-\d{2}-\d{2})", 1)
    return F.try_to_timestamp(text, F.lit("yyyy-MM-dd")).cast("date")


def archive_name(date: Column, hour: Column) -> Column:
    return F.format_string("%s-%02d.json.gz", date, hour)


def hourly_name(date: Column, hour: Column) -> Column:
    return F.format_string("keywords-%s-hour-%02d.parquet", date, hour)
