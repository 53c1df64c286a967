"""How old the newest values of each feature are."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.time import hours_between, moment
from tidemark.functions.values import ALERT, OK


def freshness_checks(definitions: DataFrame, values: DataFrame, as_of: datetime) -> DataFrame:
    """A check `freshness_hours` per definition: hours from its newest value up to `as_of`.

    Older than the definition's `freshness_hours`, or no values at all, is an alert. Only the
    name and moment of the values are read.
    """
    newest = (
        values.where(F.col("event_timestamp") <= F.lit(moment(as_of)))
        .groupBy("feature_name")
        .agg(F.max("event_timestamp").alias("newest"))
    )
    age = hours_between(F.lit(as_of), F.col("newest"))
    allowed = F.col("freshness_hours")
    return definitions.join(newest, "feature_name", "left").select(
        F.col("feature_name").alias("name"),
        F.lit("freshness_hours").alias("metric"),
        age.alias("value"),
        F.when(age.isNull() | (age > allowed), ALERT).otherwise(OK).alias("status"),
        F.when(age.isNull(), "no values at all")
        .otherwise(
            F.format_string(
                "newest values are %.1f hours old, allowed %d", F.bround(age, 1), allowed
            )
        )
        .alias("message"),
    )
