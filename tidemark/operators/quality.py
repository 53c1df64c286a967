"""Quality checks of one snapshot against the feature definitions."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.values import ALERT, OK, general, percent, thousands

CHECK_COLUMNS = ["name", "metric", "value", "status", "message"]


def snapshot_stats(snapshot: DataFrame) -> DataFrame:
    """Rows, nulls, minimum and maximum per feature, in one pass over the snapshot."""
    return snapshot.groupBy("feature_name").agg(
        F.count(F.lit(1)).alias("n_values"),
        F.count_if(F.col("value").isNull()).alias("n_null"),
        F.min("value").alias("min_value"),
        F.max("value").alias("max_value"),
    )


def _check(name: Column, metric: str, value: Column, failed: Column, message: Column) -> Column:
    return F.struct(
        name.alias("name"),
        F.lit(metric).alias("metric"),
        value.cast("double").alias("value"),
        F.when(failed, ALERT).otherwise(OK).alias("status"),
        message.alias("message"),
    )


def quality_checks(definitions: DataFrame, snapshot: DataFrame, as_of: datetime) -> DataFrame:
    """One row per check: `name, metric, value, status, message`.

    Per feature: `row_count` (values must exist), `null_share` (at most `null_threshold`),
    `minimum` and `maximum` (within `expected_min` and `expected_max`, where those are set and
    there is a value). `definitions` holds the features to check, `snapshot` their values at
    `as_of`. The snapshot shrinks to one row per feature before it meets the definitions.
    """
    features = definitions.join(snapshot_stats(snapshot), "feature_name", "left")
    name = F.col("feature_name")
    count = F.coalesce(F.col("n_values"), F.lit(0))
    present = count > 0
    share = F.try_divide(F.col("n_null"), F.col("n_values"))
    low, expected_low = F.col("min_value"), F.col("expected_min")
    high, expected_high = F.col("max_value"), F.col("expected_max")

    row_count = _check(
        name,
        "row_count",
        count,
        ~present,
        F.when(present, F.concat(thousands(count), F.lit(" values"))).otherwise(
            f"no values for {as_of.isoformat()}"
        ),
    )
    null_share = _check(
        name,
        "null_share",
        share,
        share > F.col("null_threshold"),
        F.concat(
            percent(share),
            F.lit(" of values are null, allowed "),
            percent(F.col("null_threshold")),
        ),
    )
    minimum = _check(
        name,
        "minimum",
        low,
        low < expected_low,
        F.concat(
            F.lit("minimum "),
            general(low),
            F.when(low < expected_low, " is below the expected ").otherwise(", expected at least "),
            general(expected_low),
        ),
    )
    maximum = _check(
        name,
        "maximum",
        high,
        high > expected_high,
        F.concat(
            F.lit("maximum "),
            general(high),
            F.when(high > expected_high, " is above the expected ").otherwise(
                ", expected at most "
            ),
            general(expected_high),
        ),
    )
    checks = F.array_compact(
        F.array(
            row_count,
            F.when(present, null_share),
            F.when(low.isNotNull() & expected_low.isNotNull(), minimum),
            F.when(high.isNotNull() & expected_high.isNotNull(), maximum),
        )
    )
    return features.select(F.explode(checks).alias("check")).select("check.*")


def problems(checks: DataFrame) -> DataFrame:
    """The failed checks as text, one column `problem`."""
    return checks.where(F.col("status") == ALERT).select(
        F.concat("name", F.lit(": "), "message").alias("problem")
    )
