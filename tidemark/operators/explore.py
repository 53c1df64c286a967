"""A first look at a training set."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.drift import quantiles, value_counts
from tidemark.operators.reshape import to_long


def label_rate(training: DataFrame) -> DataFrame:
    return training.agg(F.avg("label").alias("label_rate"))


def label_rate_by_snapshot(training: DataFrame) -> DataFrame:
    """The rate per snapshot, and overall in the row without a snapshot."""
    return training.rollup("event_timestamp").agg(F.avg("label").alias("label_rate"))


def missing_share(training: DataFrame, columns: Sequence[str]) -> DataFrame:
    """`column_name, missing_share`, all columns in one pass."""
    shares = training.agg(
        *[F.avg(F.col(name).isNull().cast("int")).alias(name) for name in columns]
    )
    return shares.unpivot([], list(columns), "column_name", "missing_share")


def means_by_label(training: DataFrame, columns: Sequence[str]) -> DataFrame:
    return training.groupBy("label").agg(*[F.avg(name).alias(name) for name in columns])


def describe(
    training: DataFrame, columns: Sequence[str], slices: int | None = None
) -> DataFrame:
    """Count, mean, sample deviation, minimum, exact quartiles and maximum per column."""
    counts = value_counts(to_long(training, columns, []))
    present = counts.where(F.col("value").isNotNull())
    value, n = F.col("value"), F.col("n")
    size, mean = F.sum(n), F.sum(value * n) / F.sum(n)
    sums = present.groupBy("feature_name").agg(
        size.alias("count"),
        mean.alias("mean"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
    )
    # Deviations from the mean in a second pass: sums of squares would lose digits
    squares = (
        present.join(F.broadcast(sums.select("feature_name", "mean")), "feature_name")
        .groupBy("feature_name")
        .agg(F.sum(n * (value - F.col("mean")) * (value - F.col("mean"))).alias("squares"))
    )
    quartiles = (
        quantiles(counts, 4, slices)
        .groupBy("feature_name")
        .agg(
            *[
                F.max(F.when(F.col("k") == k, F.col("quantile"))).alias(f"q{25 * k}")
                for k in (1, 2, 3)
            ]
        )
    )
    joined = sums.join(squares, "feature_name").join(quartiles, "feature_name", "left")
    quartile = lambda name: F.coalesce(F.col(name), F.col("min"))
    return joined.select(
        F.col("feature_name").alias("column_name"),
        "count",
        "mean",
        F.when(F.col("count") > 1, F.sqrt(F.col("squares") / (F.col("count") - 1))).alias("std"),
        "min",
        quartile("q25").alias("q25"),
        quartile("q50").alias("q50"),
        quartile("q75").alias("q75"),
        "max",
    )


def exploration_report(training: DataFrame, columns: Sequence[str]) -> dict[str, DataFrame]:
    """Everything above for one training set; pass a written frame, it is read once per part."""
    return {
        "describe": describe(training, columns),
        "label_rate": label_rate_by_snapshot(training),
        "missing_share": missing_share(training, columns),
        "means_by_label": means_by_label(training, columns),
    }
