"""Time features on ``timestamp`` and ``timestamp_ntz`` columns, null in, null out."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from patchloom.functions.keys import _column

_MICROS = 1_000_000


def ceil_minutes_epoch(ts: str | Column, minutes: int = 15) -> Column:
    """Round up to ``minutes`` counted from the start of the hour, as epoch seconds.

    The wall clock is read in the session zone and re-labelled as UTC. Steps are
    anchored at the hour, so a step that does not divide 60 may pass into the
    next hour. The arithmetic is integral, in microseconds.
    """
    column = _column(ts)
    hour_start = F.unix_date(column.cast("date")).cast("bigint") * 86400 + F.hour(column) * 3600
    second = F.extract(F.lit("SECOND"), column)
    in_hour = F.minute(column).cast("bigint") * 60 * _MICROS + (second * _MICROS).cast("bigint")
    step = minutes * 60
    steps = F.floor((in_hour + step * _MICROS - 1) / (step * _MICROS))
    return hour_start + steps * step


def ceil_minutes(ts: str | Column, minutes: int = 15, zoneless: bool = False) -> Column:
    """``ceil_minutes_epoch`` as a timestamp, or as a ``timestamp_ntz``."""
    epoch = ceil_minutes_epoch(ts, minutes)
    if not zoneless:
        return F.timestamp_seconds(epoch)
    start = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return start + F.make_dt_interval(secs=epoch.cast("decimal(18,6)"))


def day_of_week(ts: str | Column) -> Column:
    """Day of the week, Monday = 0."""
    return F.weekday(_column(ts))


def hour_of_day(ts: str | Column) -> Column:
    return F.hour(_column(ts))


def duration_minutes(start: str | Column, end: str | Column) -> Column:
    """Minutes by the wall clock from ``start`` to ``end``, fractional, negative when reversed."""
    # Subtraction leaves zone-less timestamps alone; timestamp_diff would read them
    # in the session zone, where some hours do not exist.
    seconds = (_column(end) - _column(start)).cast("interval second").cast("decimal(18,6)")
    return (seconds * _MICROS).cast("bigint") / F.lit(60.0 * _MICROS)


def timestamp_of(text: str) -> Column:
    """A constant timestamp from text, read in the session zone."""
    return F.to_timestamp(F.lit(text))
