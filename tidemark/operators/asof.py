"""The point-in-time join: the values each request row could have known at its moment."""

from __future__ import annotations

import math
from collections.abc import Mapping
from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.time import still_valid
from tidemark.operators.hot import HOT_ROWS, hot_keys, lookup_join, sliced, split

VALUE_COLUMNS = ["feature_name", "entity_id", "event_timestamp", "value"]


def asof_join(
    requests: DataFrame,
    values: DataFrame,
    ttls: Mapping[str, timedelta | None],
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Add one column per feature to the requests: its newest value known by then.

    `requests` has `entity_id`, `event_timestamp` and any other columns; each row gives one row.
    `values` is long: `feature_name, entity_id, event_timestamp, value`. Values that were computed
    together may come wide, one column per feature and a row per moment at which all of them were
    stored; such a row is one place in the timeline instead of one per feature. `ttls` lists the
    wanted features in column order, each with how long its values stay valid (None: forever).

    For each request and feature the value is the one with the greatest timestamp at or before the
    request and not older than the ttl. A stored null is a value: it hides older ones. Without a
    value the column is null.

    Requests and values of an entity are sorted into one timeline, and the last value of every
    feature is carried along it: a single shuffle by entity, however many features are wanted. An
    entity with more than `hot_rows` rows gets its timeline cut into slices instead.
    `hot_rows=None` skips the look for such entities, for inputs whose rows per entity are bounded.
    """
    values = values.where(F.col("entity_id").isNotNull())
    if "feature_name" in values.columns:
        values = values.where(F.col("feature_name").isin(list(ttls))).select(*VALUE_COLUMNS)
    else:
        doubles = [F.col(name).cast("double").alias(name) for name in ttls]
        values = values.select("entity_id", "event_timestamp", *doubles)
    if hot_rows is None:
        return _one_timeline(requests, values, ttls)
    ids = requests.select("entity_id").unionByName(values.select("entity_id"))
    hot = hot_keys(ids, ["entity_id"], hot_rows)
    if hot is None:
        return _one_timeline(requests, values, ttls)

    cold_requests, hot_requests = split(requests, hot, ["entity_id"])
    cold_values, hot_values = split(values, hot, ["entity_id"])
    total = hot.agg(F.sum("n_rows")).first()[0]
    in_slices = _sliced_timeline(
        hot_requests.select("entity_id", "event_timestamp").distinct(),
        hot_values,
        ttls,
        math.ceil(total / hot_rows),
    )
    return _one_timeline(cold_requests, cold_values, ttls).unionByName(
        lookup_join(hot_requests, in_slices, ["entity_id", "event_timestamp"], hot_rows)
    )


def _states(names: Mapping[str, object]) -> dict[str, tuple[str, str]]:
    """The two columns that carry each feature along the timeline: stamp and value.

    Plain numbers sort and carry much faster than structs. The stamp is twice the microseconds of
    the moment, plus one when the stored value is null; so "stored as null" and "never stored" (no
    stamp) stay apart.
    """
    return {name: (f"_stamp_{n}", f"_value_{n}") for n, name in enumerate(names)}


def _timeline(requests: DataFrame, values: DataFrame, ttls: Mapping) -> DataFrame:
    """Values (`_kind` 0) and requests (`_kind` 1) in one frame, values in their state columns."""
    long = "feature_name" in values.columns
    states = []
    for name, (stamp_column, value_column) in _states(ttls).items():
        found = F.col("value" if long else name)
        stamp = F.unix_micros("event_timestamp") * 2 + found.isNull().cast("bigint")
        value = F.coalesce(found, F.lit(0.0))
        if long:
            own = F.col("feature_name") == name
            stamp, value = F.when(own, stamp), F.when(own, value)
        states += [stamp.alias(stamp_column), value.alias(value_column)]
    stored = values.select("entity_id", "event_timestamp", F.lit(0).alias("_kind"), *states)
    asked = requests.select(
        "entity_id",
        "event_timestamp",
        F.lit(1).alias("_kind"),
        F.struct(*requests.columns).alias("_request"),
    )
    return stored.unionByName(asked, allowMissingColumns=True)


def _carried(ttls: Mapping, window) -> list[Column]:
    """Every state's last value in the window."""
    columns = [column for pair in _states(ttls).values() for column in pair]
    return [F.last(column, ignorenulls=True).over(window).alias(column) for column in columns]


def _value_at_request(stamp: Column, value: Column, ttl: timedelta | None) -> Column:
    fresh = still_valid(F.timestamp_micros(F.shiftright(stamp, 1)), F.col("event_timestamp"), ttl)
    return F.when(fresh & (stamp.bitwiseAND(F.lit(1)) == 0), value)


def _one_timeline(requests: DataFrame, values: DataFrame, ttls: Mapping) -> DataFrame:
    # Requests without an entity match nothing; spreading them keeps them out of one task
    spread = F.when(F.col("entity_id").isNull(), F.pmod(F.xxhash64("_request"), F.lit(1024)))
    rows = _timeline(requests, values, ttls).withColumn("_spread", spread)
    so_far = (
        Window.partitionBy("entity_id", "_spread")
        .orderBy("event_timestamp", "_kind")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    carried = rows.select("event_timestamp", "_kind", "_request", *_carried(ttls, so_far))
    return carried.where(F.col("_kind") == 1).select(
        "_request.*",
        *[
            _value_at_request(F.col(stamp), F.col(value), ttls[name]).alias(name)
            for name, (stamp, value) in _states(ttls).items()
        ],
    )


def _sliced_timeline(
    moments: DataFrame, values: DataFrame, ttls: Mapping, slices: int
) -> DataFrame:
    """The features at distinct (entity, moment) pairs, the timelines cut into slices.

    Each slice carries its own values; what it starts from is the last state of the entity's
    earlier slices. There are at most slices + entities such starting states.
    """
    states = _states(ttls)
    ranged = sliced(
        _timeline(moments, values, ttls).drop("_request"),
        ["entity_id", "event_timestamp", "_kind"],
        slices,
    )
    ends = []
    for stamp, value in states.values():
        ends += [F.max(stamp).alias(stamp), F.max_by(value, stamp).alias(value)]
    earlier = (
        Window.partitionBy("entity_id")
        .orderBy("_slice")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    starts = (
        ranged.groupBy("entity_id", "_slice")
        .agg(*ends)
        .select("entity_id", "_slice", F.struct(*_carried(ttls, earlier)).alias("_start"))
    )
    so_far = (
        Window.partitionBy("_slice", "entity_id")
        .orderBy("event_timestamp", "_kind")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    carried = ranged.select(
        "entity_id", "event_timestamp", "_kind", "_slice", *_carried(ttls, so_far)
    ).where(F.col("_kind") == 1)
    answers = [
        _value_at_request(
            F.coalesce(F.col(stamp), F.col(f"_start.{stamp}")),
            F.coalesce(F.col(value), F.col(f"_start.{value}")),
            ttls[name],
        ).alias(name)
        for name, (stamp, value) in states.items()
    ]
    return carried.join(F.broadcast(starts), ["entity_id", "_slice"]).select(
        "entity_id", "event_timestamp", *answers
    )
