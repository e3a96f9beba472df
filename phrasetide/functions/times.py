"""Epoch seconds, timestamps and their display forms (session zone is UTC)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Display formats of the feed, its older 12-hour form, and cursors.
DISPLAY = "dd/MM/yy, HH:mm:ss"
DISPLAY_12H = "dd/MM/yy, h:mm:ss a"
INSTANT = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def from_epoch(seconds: Column | str) -> Column:
    """Timestamp of epoch seconds given as a number or as numeric text.

    Goes through a decimal rather than a double, so microseconds survive.
    """
    seconds = F.col(seconds) if isinstance(seconds, str) else seconds
    return F.timestamp_seconds(seconds.cast("decimal(20,6)"))


def to_epoch_text(ts: Column | str) -> Column:
    """Epoch seconds as text, exact to the microsecond."""
    return (F.unix_micros(ts).cast("decimal(20,0)") / F.lit(1000000).cast("decimal(7,0)")) \
        .cast("decimal(20,6)").cast("string")


def display_time(ts: Column | str, twelve_hour: bool = False) -> Column:
    """Feed time; the older form writes am/pm in lower case."""
    if twelve_hour:
        return F.lower(F.date_format(ts, DISPLAY_12H))
    return F.date_format(ts, DISPLAY)


def instant(ts: Column | str) -> Column:
    """ISO instant of a cursor, whole seconds."""
    return F.date_format(ts, INSTANT)


def to_millis(ts: Column | str) -> Column:
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.unix_millis(ts.cast("timestamp"))
