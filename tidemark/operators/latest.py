"""The newest valid value of every feature, per entity, as of a moment."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.time import moment


def _valid(values: DataFrame, as_of: datetime, ttl: timedelta | None) -> DataFrame:
    values = values.where(F.col("event_timestamp") <= F.lit(moment(as_of)))
    return values if ttl is None else values.where(F.col("event_timestamp") >= F.lit(as_of - ttl))


def latest_values(values: DataFrame, as_of: datetime, ttl: timedelta | None) -> DataFrame:
    """One row per entity and feature: the newest value, a stored null included.

    Values after `as_of` or older than the ttl do not count. Both aggregates keep plain numbers, so
    they run as hash aggregation and long histories shrink before they are shuffled.
    """
    return (
        _valid(values, as_of, ttl)
        .groupBy("entity_id", "feature_name")
        .agg(
            F.max_by("value", "event_timestamp").alias("value"),
            F.max("event_timestamp").alias("event_timestamp"),
        )
        .select("entity_id", "feature_name", "event_timestamp", "value")
    )


def latest_rows(
    values: DataFrame, as_of: datetime, ttl: timedelta | None, features: Sequence[str]
) -> DataFrame:
    """One row per entity: `entity_id, event_timestamp, values`.

    `values` maps the features that have a valid value to it (null if null was stored);
    `event_timestamp` is the newest moment among them. One grouping by entity does it all.
    """
    newest = []
    for number, name in enumerate(features):
        own = F.when(F.col("feature_name") == name, F.col("event_timestamp"))
        newest += [
            F.max(own).alias(f"_at_{number}"),
            F.max_by("value", own).alias(f"_value_{number}"),
        ]
    wide = (
        _valid(values, as_of, ttl)
        .where(F.col("feature_name").isin(list(features)))
        .groupBy("entity_id")
        .agg(F.max("event_timestamp").alias("event_timestamp"), *newest)
    )
    entries = [
        F.when(
            F.col(f"_at_{number}").isNotNull(),
            F.struct(F.lit(name).alias("key"), F.col(f"_value_{number}").alias("value")),
        )
        for number, name in enumerate(features)
    ]
    return wide.select(
        "entity_id",
        "event_timestamp",
        F.map_from_entries(F.array_compact(F.array(*entries))).alias("values"),
    )


def without_nulls(rows: DataFrame) -> DataFrame:
    """Drop the null entries of each entity's map; the entity itself stays."""
    return rows.withColumn("values", F.map_filter("values", lambda _, value: value.isNotNull()))
