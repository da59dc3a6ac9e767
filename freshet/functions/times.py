"""Times given as epoch seconds, digit strings or ISO text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from freshet.functions.text import _col, blank_to_null


def epoch_time(c: Column | str, positive_only: bool = False) -> Column:
    """Integer text (or an integer) to a timestamp; anything else is null."""
    seconds = F.trim(_col(c).cast("string")).try_cast("bigint")
    if positive_only:
        seconds = F.when(seconds > 0, seconds)
    return F.timestamp_seconds(seconds)


def event_time(c: Column | str) -> Column:
    """Digits are epoch seconds, other text an ISO time; empty or unreadable is null."""
    text = blank_to_null(_col(c).cast("string"))
    return F.when(text.rlike("^[0-9]+$"), F.timestamp_seconds(text.try_cast("bigint"))).otherwise(
        text.try_cast("timestamp")
    )


def as_zoned(c: Column | str) -> Column:
    """A zone-less timestamp column as an instant (the session zone is UTC)."""
    return _col(c).cast("timestamp")


def plain_time(c: Column | str) -> Column:
    return _col(c).cast("timestamp_ntz")


def epoch_seconds(c: Column | str) -> Column:
    return F.unix_seconds(_col(c).cast("timestamp"))


def epoch_micros(c: Column | str) -> Column:
    return F.unix_micros(_col(c).cast("timestamp"))
