"""Dates and epochs, independent of the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"


def _named(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def activity_date(epoch_micros: Column | str) -> Column:
    """Epoch microseconds as a zone-free timestamp, cut to whole seconds."""
    seconds = F.call_function("div", _named(epoch_micros), F.lit(1_000_000).cast("long"))
    return from_epoch(seconds)


def from_epoch(seconds: Column | str) -> Column:
    """Epoch seconds as a zone-free timestamp."""
    return F.timestamp_add("SECOND", _named(seconds).cast("long"), F.expr(_EPOCH))


def to_epoch(ts: Column | str) -> Column:
    """Zone-free timestamp as whole epoch seconds."""
    return F.floor(epoch_micros(ts) / 1_000_000)


def epoch_micros(ts: Column | str) -> Column:
    """Zone-free timestamp as epoch microseconds."""
    return F.timestamp_diff("MICROSECOND", F.expr(_EPOCH), _named(ts).cast("timestamp_ntz"))


def coerce_date(text: Column | str) -> Column:
    """The date a text holds, or null when it holds none."""
    return _named(text).try_cast("date")


def full_years(since: Column | str, as_of: Column | str | None = None) -> Column:
    """Whole 365-day years from a loosely typed date; unreadable dates count 0."""
    today = F.current_date() if as_of is None else (
        F.lit(as_of).cast("date") if isinstance(as_of, str) else as_of)
    days = F.datediff(today, coerce_date(since))
    return F.coalesce(F.floor(days / 365), F.lit(0)).cast("int")


def social_year(ts: Column | str, first_month: int = 6) -> Column:
    """Social year as ``start-end``.

    The year starts after ``first_month``: a day inside that month still
    counts to the year before.
    """
    ts = _named(ts)
    start = F.when(F.month(ts) > first_month, F.year(ts)).otherwise(F.year(ts) - 1)
    return F.concat(start.cast("string"), F.lit("-"), (start + 1).cast("string"))
