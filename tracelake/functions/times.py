"""Time helpers. Every 'now' is an explicit as_of; the session time zone is UTC."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F

from tracelake.functions.text import SPACE, col, strip

EPOCH = "1970-01-01 00:00:00"


def instant(value: str | dt.datetime | Column) -> Column:
    """A zone-less timestamp literal (or column) to compare event times with."""
    if isinstance(value, Column):
        return value
    return F.lit(str(value)).cast("timestamp_ntz")


def rolling_since(c: Column | str, as_of, days: int) -> Column:
    """Within the last n times 24 hours."""
    return col(c) >= instant(as_of) - F.expr(f"INTERVAL {int(days)} DAYS")


def calendar_since(c: Column | str, as_of, days: int) -> Column:
    """On or after midnight n calendar days ago."""
    start = F.date_sub(F.to_date(instant(as_of)), int(days))
    return col(c) >= start.cast("timestamp_ntz")


def epoch_seconds(c: Column | str) -> Column:
    return F.floor(F.timestamp_diff("MICROSECOND", instant(EPOCH), col(c)) / F.lit(1_000_000)).cast("long")


def from_epoch(c: Column | str) -> Column:
    return F.timestamp_seconds(col(c))


def whole_days_between(later: Column, earlier: Column) -> Column:
    """Full 24 h days, truncated; not a calendar difference."""
    return F.floor(F.timestamp_diff("SECOND", earlier, later) / F.lit(86400)).cast("long")


def week_start(c: Column | str) -> Column:
    return F.to_date(F.date_trunc("week", col(c)))


def week_end(c: Column | str) -> Column:
    return F.date_add(week_start(c), 6)


_FULL = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}(?:\.\d+)?(?:Z|[+-]\d{2}:\d{2})$"
_ISO = r"^\d{4}-\d{2}-\d{2}(?:[T ]\d{2}(?::?\d{2}(?::?\d{2}(?:[.,]\d+)?)?)?(?:Z|[+-]\d{2}(?::?\d{2})?)?)?$"
_ZONE = r"[T ].*(?:Z|[+-]\d{2}(?::?\d{2})?)$"


def iso_instant(c: Column | str) -> Column:
    """ISO 8601 text to a timestamp; null when it cannot be read. Text without a zone is UTC."""
    text = col(c)
    point = F.regexp_replace(F.regexp_replace(text, " ", "T"), ",", ".")
    minutes = F.regexp_replace(point, r"^(\d{4}-\d{2}-\d{2}T\d{2})(?=$|[Z+-])", "$1:00")
    full = F.regexp_replace(minutes, r"^(\d{4}-\d{2}-\d{2}T\d{2}:\d{2})(?=$|[Z+-])", "$1:00")
    zoned = (
        F.when(F.regexp_like(text, F.lit(_ZONE)), full)
        .when(F.contains(full, F.lit("T")), F.concat(full, F.lit("Z")))
        .otherwise(F.concat(full, F.lit("T00:00:00Z")))
    )
    return (
        F.when(F.regexp_like(text, F.lit(_FULL)), text.try_cast("timestamp"))
        .when(F.regexp_like(text, F.lit(_ISO)), zoned.try_cast("timestamp"))
    )


def iso_epoch_or_zero(c: Column | str) -> Column:
    return F.coalesce(F.unix_seconds(iso_instant(c)), F.lit(0).cast("long"))


def stamp_epoch(c: Column | str) -> Column:
    """Transcript header time to epoch seconds; null when it cannot be read."""
    return F.unix_seconds(iso_instant(strip(c)))


def yymmdd(epoch: Column | str) -> Column:
    e = col(epoch)
    return F.when(F.coalesce(e, F.lit(0)) == 0, F.lit("")).otherwise(
        F.date_format(F.timestamp_seconds(e), "yyMMdd")
    )


def millis_or_seconds(c: Column | str) -> Column:
    """Epoch values above ten billion are milliseconds."""
    v = col(c).cast("long")
    return F.when(v > F.lit(10_000_000_000), F.floor(v / F.lit(1000)).cast("long")).otherwise(v)


__all__ = [
    "SPACE", "calendar_since", "epoch_seconds", "from_epoch", "instant", "iso_epoch_or_zero", "iso_instant",
    "millis_or_seconds", "rolling_since", "stamp_epoch", "week_end", "week_start", "whole_days_between", "yymmdd",
]
