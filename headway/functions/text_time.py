"""Text and time expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_time(text: Column) -> Column:
    """ISO-8601 text to a zone-less timestamp; unreadable text gives NULL."""
    return F.try_to_timestamp(text).cast("timestamp_ntz")


def to_millis(ts: Column) -> Column:
    """Drop precision below a millisecond."""
    return F.date_trunc("millisecond", ts).cast("timestamp_ntz")


def hour_of(ts: Column) -> Column:
    return F.date_trunc("hour", ts).cast("timestamp_ntz")


def hour_key(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH':00:00'")


def shift(ts: Column, interval: str) -> Column:
    """ts plus an interval such as ``1 hour`` or ``-2 hours``."""
    return ts + F.expr(f"INTERVAL '{interval}'")


def at(literal: str) -> Column:
    """A zone-less timestamp literal, so a filter on it reaches the scan."""
    return F.lit(literal).cast("timestamp_ntz")


def slug_title(slug: Column) -> Column:
    """``waterloo-city`` to ``Waterloo City``; later letters keep their case."""
    words = F.split(F.replace(slug, F.lit("-"), F.lit(" ")), r"\b")
    return F.array_join(
        F.transform(words, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substr(w, F.lit(2)))), ""
    )


def split_list(text: Column) -> Column:
    """Comma list to trimmed elements."""
    return F.transform(F.split(text, ","), lambda item: F.trim(item))
