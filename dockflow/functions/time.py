"""Time expressions on zone-less timestamps; none depends on the session zone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockflow.params import HOUR

_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def epoch_micros(ts: Column | str) -> Column:
    return F.timestamp_diff("MICROSECOND", F.expr(_EPOCH), _c(ts))


def floor_to(ts: Column | str, seconds: int = HOUR) -> Column:
    """Start of the ``seconds`` wide bucket, counted from the epoch."""
    if seconds == HOUR:
        ts = _c(ts)
        zero = F.lit(0)
        return F.to_date(ts).cast("timestamp_ntz") + F.make_dt_interval(zero, F.hour(ts), zero, F.lit(0))
    width = F.lit(seconds * 1_000_000)
    micros = epoch_micros(ts)
    return F.timestamp_add("MICROSECOND", micros - F.pmod(micros, width), F.expr(_EPOCH))


def add_seconds(ts: Column | str, seconds: Column | int) -> Column:
    seconds = F.lit(seconds) if isinstance(seconds, int) else seconds
    return F.timestamp_add("SECOND", seconds, _c(ts))


def day_start(day: Column | str) -> Column:
    """Midnight of a date, zone-less."""
    return _c(day).cast("timestamp_ntz")


def is_weekend(ts: Column | str) -> Column:
    """Saturday or Sunday (Monday is 0)."""
    return F.weekday(_c(ts)).isin(5, 6)


def context_of(ts: Column | str) -> Column:
    """Index of the (hour, weekend) context, 0 to 47."""
    return F.hour(_c(ts)) * 2 + is_weekend(ts).cast("int")


def duration_minutes(start: Column | str = "started_at", end: Column | str = "ended_at") -> Column:
    return F.timestamp_diff("MICROSECOND", _c(start), _c(end)) / F.lit(6e7)


def with_time_features(trips: DataFrame) -> DataFrame:
    """Hour, day of week (Monday 0), date and weekend flag of the trip start."""
    return trips.withColumns(
        {
            "hour": F.hour("started_at"),
            "day_of_week": F.weekday("started_at"),
            "date": F.to_date("started_at"),
            "is_weekend": is_weekend("started_at"),
        }
    )


def started_between(start: str | None, end: str | None, whole_end_day: bool = False, ts: str = "started_at") -> Column:
    """Start-time filter from bare dates.

    The end date means its midnight, so only that instant of the last day
    passes; ``whole_end_day`` keeps the day.
    """
    cond = F.lit(True)
    ts = F.col(ts)
    if start:
        cond = cond & (ts >= F.lit(start).cast("timestamp_ntz"))
    if end:
        bound = F.lit(end).cast("timestamp_ntz")
        if whole_end_day:
            cond = cond & (ts < bound + F.expr("INTERVAL 1 DAY"))
        else:
            cond = cond & (ts <= bound)
    return cond
