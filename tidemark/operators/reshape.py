"""Between one column per feature, one row per feature and one map per entity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def to_long(wide: DataFrame, features: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """One row per key and feature, the value as a double."""
    doubles = wide.select(*keys, *[F.col(name).cast("double").alias(name) for name in features])
    return doubles.unpivot(list(keys), list(features), "feature_name", "value")


def to_wide(long: DataFrame, features: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """One column per feature in the given order; a feature without a row is null."""
    return long.groupBy(*keys).agg(
        *[
            F.max(F.when(F.col("feature_name") == name, F.col("value"))).alias(name)
            for name in features
        ]
    )


def check_columns(frame: DataFrame, features: Sequence[str], source: str) -> None:
    """Raise when the frame lacks a registered feature or the entity; reads no data."""
    missing = {*features, "entity_id"} - set(frame.columns)
    if missing:
        raise ValueError(f"SQL of view '{source}' does not return: {sorted(missing)}")
