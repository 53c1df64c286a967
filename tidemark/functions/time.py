"""Moments, windows and ages. Every timestamp is UTC."""

from __future__ import annotations

from datetime import UTC, date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MICROS_PER_DAY = 86_400_000_000
MICROS_PER_HOUR = 3_600_000_000


def moment(value: datetime) -> datetime:
    """Pass a timezone-aware datetime through; a naive one is an error."""
    if value.tzinfo is None:
        raise ValueError("as_of must be timezone-aware")
    return value


def midnight(day: date) -> datetime:
    return datetime(day.year, day.month, day.day, tzinfo=UTC)


EPOCH = datetime(1970, 1, 1, tzinfo=UTC)
MICROSECOND = timedelta(microseconds=1)


def epoch_micros(value: datetime) -> int:
    return (moment(value) - EPOCH) // MICROSECOND


def from_epoch_micros(micros: int) -> datetime:
    return EPOCH + micros * MICROSECOND


def days_between(later: Column, earlier: Column) -> Column:
    """Fractional days from `earlier` to `later`."""
    return (F.unix_micros(later) - F.unix_micros(earlier)) / F.lit(float(MICROS_PER_DAY))


def hours_between(later: Column, earlier: Column) -> Column:
    """Fractional hours from `earlier` to `later`."""
    return (F.unix_micros(later) - F.unix_micros(earlier)) / F.lit(float(MICROS_PER_HOUR))


def trailing(ts: Column, as_of: datetime, span: timedelta) -> Column:
    """`ts` lies in `[as_of - span, as_of)`."""
    return (ts < F.lit(as_of)) & (ts >= F.lit(as_of - span))


def forward(ts: Column, as_of: datetime, span: timedelta) -> Column:
    """`ts` lies in `[as_of, as_of + span)`."""
    return (ts >= F.lit(as_of)) & (ts < F.lit(as_of + span))


def still_valid(observed: Column, at: Column, ttl: timedelta | None) -> Column:
    """A value observed at `observed` has not expired at `at`; no ttl means it never does."""
    if ttl is None:
        return observed.isNotNull()
    return observed >= at - F.lit(ttl)


def day_number(ts: Column) -> Column:
    """Whole days since 1970-01-01."""
    return F.unix_date(F.to_date(ts))


def from_iso_text(text: Column) -> Column:
    """A day or moment in ISO form; without an offset it is in the session's zone, which is UTC."""
    return text.cast("timestamp")


def iso_text(ts: Column) -> Column:
    """A moment in ISO form, with its offset."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ssxxx")


def within_days(
    frame: DataFrame, column: str, since: datetime | None = None, until: datetime | None = None
) -> DataFrame:
    """Bound the day column of a table partitioned by day, so that only those days are read.

    Frames without that column pass as they are; the exact bounds are up to the caller.
    """
    if column not in frame.columns:
        return frame
    if since is not None:
        frame = frame.where(F.col(column) >= F.lit(since.astimezone(UTC).date()))
    if until is not None:
        frame = frame.where(F.col(column) <= F.lit(until.astimezone(UTC).date()))
    return frame
