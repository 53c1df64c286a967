"""Merge new rows into stored ones by key."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEYS = ["view_name", "feature_name", "entity_id", "event_timestamp"]


def merge_values(stored: DataFrame, new: DataFrame, now: datetime) -> DataFrame:
    """All keys of both sides with a column `change`.

    `inserted` and `changed` rows carry the new value and `created_at = now`; `unchanged` rows
    (the same value, null included) and `kept` ones (not computed this time) stay as they were.
    """
    new_side = new.select(*KEYS, F.col("value").alias("_new"), F.lit(True).alias("_computed"))
    old_side = stored.select(
        *KEYS, F.col("value").alias("_old"), "created_at", F.lit(True).alias("_stored")
    )
    change = (
        F.when(F.col("_stored").isNull(), "inserted")
        .when(F.col("_computed").isNull(), "kept")
        .when(F.col("_old").eqNullSafe(F.col("_new")), "unchanged")
        .otherwise("changed")
    )
    written = F.col("change").isin("inserted", "changed")
    value = F.when(F.col("change") == "kept", F.col("_old")).otherwise(F.col("_new"))
    return (
        old_side.join(new_side, KEYS, "full_outer")
        .withColumn("change", change)
        .select(
            *KEYS,
            value.alias("value"),
            F.when(written, F.lit(now)).otherwise(F.col("created_at")).alias("created_at"),
            "change",
        )
    )
