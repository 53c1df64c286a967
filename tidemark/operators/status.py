"""The current state of health out of logged checks."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.time import moment
from tidemark.functions.values import severity, status_of

ENTRY = ["metric", "value", "status", "message", "snapshot_at"]


def latest_outcomes(log: DataFrame, as_of: datetime) -> DataFrame:
    """The newest logged outcome of every (kind, name, metric) up to `as_of`."""
    newest = F.max(F.struct("snapshot_at", "value", "status", "message"))
    return (
        log.where(F.col("snapshot_at") <= F.lit(moment(as_of)))
        .groupBy("kind", "name", "metric")
        .agg(newest.alias("newest"))
        .select("kind", "name", "metric", "newest.*")
    )


def status_by_name(outcomes: DataFrame) -> DataFrame:
    """`kind, name, status, checks`: the worst status per feature or model and its checks.

    A name has one outcome per metric, so its list of checks is short.
    """
    return outcomes.groupBy("kind", "name").agg(
        status_of(F.max(severity(F.col("status")))).alias("status"),
        F.array_sort(F.collect_list(F.struct(*ENTRY))).alias("checks"),
    )


def overall_status(by_name: DataFrame) -> DataFrame:
    """One row with the worst status of all; ok without any."""
    return by_name.agg(status_of(F.max(severity(F.col("status")))).alias("status"))


def current_status(log: DataFrame, freshness: DataFrame, as_of: datetime) -> DataFrame:
    """One row: `status, as_of, features, models`, the last two maps of name to status and checks.

    Logged checks count with their newest outcome up to `as_of`; freshness is measured at `as_of`.
    """
    measured = freshness.select(
        F.lit("feature").alias("kind"),
        "name",
        "metric",
        F.lit(as_of).alias("snapshot_at"),
        "value",
        "status",
        "message",
    )
    by_name = status_by_name(latest_outcomes(log, as_of).unionByName(measured))
    summary = F.struct("name", F.struct("status", "checks"))
    of_kind = lambda kind: F.map_from_entries(
        F.array_sort(F.collect_list(F.when(F.col("kind") == kind, summary)))
    )
    return by_name.agg(
        status_of(F.max(severity(F.col("status")))).alias("status"),
        F.lit(as_of).alias("as_of"),
        of_kind("feature").alias("features"),
        of_kind("model").alias("models"),
    )
