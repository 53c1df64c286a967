"""From raw tables to stored values: one moment or a range of days."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from datetime import UTC, date, datetime
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.snapshots import daily_snapshots, each_snapshot
from tidemark.functions.time import moment
from tidemark.operators.reshape import check_columns, to_long
from tidemark.plans import purchase_stats
from tidemark.plans.store import FeatureStore
from tidemark.sources.adapters import Commerce
from tidemark.sources.registry import FeatureView

# The table of moments that SQL reads to answer for all of them at once.
SNAPSHOTS = "snapshots"
# Moments that are computed in one job where each needs a plan of its own.
UNION_MOMENTS = 31
# What a parameter is not: texts, quoted names and comments.
_PARAMETER = re.compile(
    r"""'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*"|`[^`]*`|--[^\n]*|/\*.*?\*/|(?P<parameter>:as_of\b)""",
    re.DOTALL,
)
# Errors of Spark on SQL that it cannot run as a correlated sub-query.
_NOT_CORRELATED = ("UNSUPPORTED_SUBQUERY_EXPRESSION_CATEGORY", "UNRESOLVED_COLUMN")


@dataclass(frozen=True)
class FrameView:
    """A view as DataFrame functions.

    `at` returns `entity_id` and the features at a moment; `at_once` also `event_timestamp`, for
    many midnights in one pass, and without it `at` is used for each. With `sql` the functions stand
    for that SQL and are used while the registry has it; without, the view needs none.
    """

    at: Callable[[Commerce, datetime], DataFrame]
    at_once: Callable[[Commerce, Sequence[datetime]], DataFrame] | None = None
    sql: str | None = None


_FRAME_VIEWS: dict[str, FrameView] = {}


def register_frame_view(view_name: str, view: FrameView) -> None:
    """Compute a view by functions, in this session; the registry holds its name and features."""
    _FRAME_VIEWS[view_name] = view


register_frame_view(
    purchase_stats.VIEW,
    FrameView(purchase_stats.purchase_stats, purchase_stats.purchase_stats_at, purchase_stats.SQL),
)


def frame_view(view_name: str, sql: str | None) -> FrameView | None:
    found = _FRAME_VIEWS.get(view_name)
    return found if found is not None and found.sql == sql else None


def with_moment(sql: str, moment_sql: str) -> tuple[str, int]:
    """The SQL with its parameter `:as_of` replaced, and how often it occurs.

    Texts, quoted names and comments stay as they are.
    """
    n_found = 0

    def replaced(match: re.Match) -> str:
        nonlocal n_found
        if match.group("parameter") is None:
            return match.group()
        n_found += 1
        return moment_sql

    return _PARAMETER.sub(replaced, sql), n_found


def sql_at(commerce: Commerce, sql: str, moments: Sequence[datetime]) -> DataFrame:
    """Run SQL over the raw tables for all moments at once, with the moment as `event_timestamp`.

    Three kinds of SQL give the same rows:

    * With the parameter `:as_of` it is a lateral sub-query of the table of moments, so one plan
      reads the raw tables once for all of them. Where Spark cannot take a form of correlated SQL
      apart, the moments are united.
    * Over the table `snapshots` (with the column `as_of`) it returns `event_timestamp` itself.
    * Without either it is the same at every moment, and its rows are repeated for each.
    """
    return reduce(DataFrame.unionByName, sql_parts(commerce, sql, moments, max(len(moments), 1)))


def sql_parts(
    commerce: Commerce, sql: str, moments: Sequence[datetime], size: int | None = None
) -> list[DataFrame]:
    """The rows of `sql_at`: one frame, or one for every `size` moments where they are united."""
    frames = dict(commerce.present())
    spark = frames["users"].sparkSession
    # Not from a local list, whose size Spark takes as unknown: this is the side to broadcast
    frames[SNAPSHOTS] = spark.range(1).select(
        each_snapshot(moments, lambda at: F.lit(True)).alias("as_of")
    )
    # Under names of their own, so that no view of the caller is replaced
    names = {name: f"{name}_{uuid.uuid4().hex}" for name in frames}
    for name, frame in frames.items():
        frame.createOrReplaceTempView(names[name])
    tables = ", ".join(f"{name} AS (SELECT * FROM {own})" for name, own in names.items())
    lateral, n_parameters = with_moment(sql, "_at.as_of")
    try:
        if n_parameters and moments:
            try:
                # The line break ends a comment in the last line
                found = spark.sql(
                    f"WITH {tables} SELECT _at.as_of AS _as_of, _rows.* "
                    f"FROM {SNAPSHOTS} _at, LATERAL ({lateral}\n) _rows"
                )
                return [found.withColumn("event_timestamp", F.col("_as_of")).drop("_as_of")]
            except AnalysisException as error:
                if not (error.getCondition() or "").startswith(_NOT_CORRELATED):
                    raise
        whole = f"WITH {tables} SELECT * FROM ({sql}\n)"
        if not n_parameters:
            found = spark.sql(whole)
            if "event_timestamp" not in found.columns:
                stamps = each_snapshot(moments, lambda at: F.lit(True))
                found = found.withColumn("event_timestamp", stamps)
            return [found]
        each = [
            spark.sql(whole, args={"as_of": at}).withColumn("event_timestamp", F.lit(at))
            for at in sorted(set(moments))
        ]
        size = size or UNION_MOMENTS
        return [
            reduce(DataFrame.unionByName, each[first : first + size])
            for first in range(0, len(each), size)
        ]
    finally:
        for own in names.values():
            spark.catalog.dropTempView(own)


def view_values(
    wide: DataFrame, view_name: str, features: Sequence[str], at
) -> DataFrame:
    """Long values of a computed view, stamped with `at` (a moment or a column of it)."""
    check_columns(wide, features, view_name)
    stamped = wide.withColumn("event_timestamp", F.lit(at) if isinstance(at, datetime) else at)
    long = to_long(stamped, features, ["entity_id", "event_timestamp"])
    return long.withColumn("view_name", F.lit(view_name))


def _features(store: FeatureStore, view_name: str) -> tuple[FrameView | None, FeatureView, list[str]]:
    """How a view is computed (functions, or the SQL it has), and the features that are in use."""
    view = store.registry.get_view(view_name)
    built = frame_view(view_name, view.source_sql)
    if built is None and not view.source_sql:
        raise ValueError(f"Feature view '{view_name}' has no source SQL")
    names = [feature.feature_name for feature in store.registry.in_use(view_name)]
    return built, view, names


def keep_states(store: FeatureStore, view: FeatureView, until: date) -> None:
    """Values that never expire get a state for every month, so reads need not go back further."""
    if view.ttl is None:
        store.values.advance_states(view.view_name, until)


def compute_features(
    store: FeatureStore, view_name: str, as_of: datetime, now: datetime | None = None
) -> int:
    """Compute a view as of a moment and store its values, stamped with that moment.

    Returns the rows inserted or changed: 0 when the same moment is computed again unchanged.
    Late events are picked up by computing a moment again.
    """
    moment(as_of)
    built, view, features = _features(store, view_name)
    raw = store.raw.read()
    wide = sql_at(raw, view.source_sql, [as_of]) if built is None else built.at(raw, as_of)
    written = store.values.upsert(view_values(wide, view_name, features, as_of), now)
    keep_states(store, view, as_of.astimezone(UTC).date())
    return written


def backfill(
    store: FeatureStore, view_name: str, start: date, end: date, now: datetime | None = None
) -> int:
    """Compute a view at midnight UTC of every day from start to end, inclusive.

    Functions with `at_once` and SQL take one pass over the events; functions without it, and SQL
    that Spark cannot correlate, are computed for each day, `UNION_MOMENTS` days in a job.
    """
    built, view, features = _features(store, view_name)
    days = daily_snapshots(start, end)
    raw, at = store.raw.read(), F.col("event_timestamp")
    written = sum(
        store.values.upsert(view_values(wide, view_name, features, at), now)
        for wide in _at_all(raw, built, view.source_sql, days)
    )
    keep_states(store, view, end)
    return written


def _at_all(
    raw: Commerce, built: FrameView | None, sql: str | None, days: Sequence[datetime]
) -> Iterable[DataFrame]:
    if not days:
        return
    if built is None:
        yield from sql_parts(raw, sql, days)
    elif built.at_once is not None:
        yield built.at_once(raw, days)
    else:
        for first in range(0, len(days), UNION_MOMENTS):
            part = days[first : first + UNION_MOMENTS]
            each = [built.at(raw, day).withColumn("event_timestamp", F.lit(day)) for day in part]
            yield reduce(DataFrame.unionByName, each)
