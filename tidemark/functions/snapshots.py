"""Lists of moments at which features or labels are taken."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, timedelta

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.time import epoch_micros, midnight, moment


def daily_snapshots(start: date, end: date) -> list[datetime]:
    """Midnight UTC of every day from start to end, inclusive."""
    return [midnight(start + timedelta(days=n)) for n in range((end - start).days + 1)]


def monthly_snapshots(start: date, end: date) -> list[datetime]:
    """Midnight UTC of every first of a month from start to end, inclusive."""
    months = range(start.year * 12 + start.month - 1, end.year * 12 + end.month)
    firsts = (date(month // 12, month % 12 + 1, 1) for month in months)
    return [midnight(first) for first in firsts if start <= first <= end]


def closed_months(start: date, by: datetime, horizon: timedelta) -> list[datetime]:
    """Firsts of a month from start on whose window of `horizon` has ended by a moment."""
    found = monthly_snapshots(start, (moment(by) - horizon).date())
    if not found:
        raise ValueError(f"No training snapshots between {start} and {by - horizon}")
    return found


def micros_array(snapshots: Sequence[datetime]) -> Column:
    """All snapshots as one literal, ascending and without repeats."""
    micros = sorted({epoch_micros(moment(snapshot)) for snapshot in snapshots})
    return F.lit(np.array(micros, dtype=np.int64))


def each_snapshot(snapshots: Sequence[datetime], keep) -> Column:
    """One row per snapshot for which `keep(snapshot in microseconds)` holds."""
    return F.explode(snapshot_array(snapshots, keep))


def snapshot_array(snapshots: Sequence[datetime], keep) -> Column:
    """The snapshots for which `keep(snapshot in microseconds)` holds."""
    return F.transform(F.filter(micros_array(snapshots), keep), F.timestamp_micros)
