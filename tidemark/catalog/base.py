"""Registration of queries, and the parts they share."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import UTC, date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.snapshots import daily_snapshots, monthly_snapshots
from tidemark.operators.reshape import to_long
from tidemark.plans.purchase_stats import FEATURES, purchase_stats_at
from tidemark.session import shared_folder
from tidemark.sources.adapters import Commerce, load
from tidemark.sources.schemas import zoneless

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

AS_OF = datetime(2024, 1, 20, tzinfo=UTC)
DAYS = daily_snapshots(date(2024, 1, 2), date(2024, 1, 30))
MONTHS = monthly_snapshots(date(1995, 2, 1), date(2001, 7, 1))


def query(sql: str | None = None, name: str | None = None):
    """Register a function by name (its own by default); `sql` gives the same result in DuckDB."""

    def register(function):
        key = name or function.__name__
        QUERIES[key] = lambda spark, folder: comparable(function(spark, folder))
        if sql is not None:
            SQL[key] = sql
        return function

    return register


def comparable(frame: DataFrame) -> DataFrame:
    """Doubles to six digits, timestamps without a zone."""
    rounded = {
        field.name: F.round(F.col(field.name), 6)
        for field in frame.schema.fields
        if isinstance(field.dataType, T.DoubleType)
    }
    return zoneless(frame.withColumns(rounded))


def work_folder(spark: SparkSession) -> str:
    """A new folder that all executors share."""
    return f"{shared_folder(spark)}/work-{uuid.uuid4().hex}"


def daily_rows(commerce: Commerce, snapshots=DAYS) -> DataFrame:
    """The feature view at many midnights, one row per entity and moment."""
    return purchase_stats_at(commerce, snapshots)


def daily_values(commerce: Commerce, snapshots=DAYS) -> DataFrame:
    """The feature view at many midnights, long, as the store holds it."""
    wide = daily_rows(commerce, snapshots)
    long = to_long(wide, FEATURES, ["entity_id", "event_timestamp"])
    return long.withColumn("snapshot_date", F.to_date("event_timestamp"))


def observations(spark: SparkSession, folder: str, kinds: list[str]) -> DataFrame:
    """Events as stored values: the type is the feature, amounts above 100 are stored as null."""
    events = load(spark, folder, "events").where(F.col("event_type").isin(kinds))
    return events.select(
        F.col("event_type").alias("feature_name"),
        F.col("user_id").alias("entity_id"),
        F.col("ts").alias("event_timestamp"),
        F.when(F.col("value") <= 100, F.col("value")).alias("value"),
    )


def event_requests(spark: SparkSession, folder: str, kinds: list[str]) -> DataFrame:
    """Events as request rows."""
    events = load(spark, folder, "events").where(F.col("event_type").isin(kinds))
    return events.select(
        F.col("event_id").alias("row_id"),
        F.col("user_id").alias("entity_id"),
        F.col("ts").alias("event_timestamp"),
    )


# The same tables in SQL: users u, orders o, product views v.
EVENTS_SQL = """
u AS (SELECT user_id, min(ts) AS signup_ts FROM events GROUP BY user_id),
o AS (SELECT event_id AS order_id, user_id, ts AS order_ts,
             CAST(value AS DECIMAL(12,2)) AS total_amount
      FROM events WHERE event_type = 'purchase'),
v AS (SELECT event_id AS view_id, user_id, ts AS view_ts FROM events WHERE event_type = 'view')"""

TRADE_SQL = """
u AS (SELECT o_custkey AS user_id, min(o_orderdate) AS signup_ts FROM orders GROUP BY o_custkey),
o AS (SELECT o_orderkey AS order_id, o_custkey AS user_id, o_orderdate AS order_ts,
             CAST(o_totalprice AS DECIMAL(12,2)) AS total_amount FROM orders),
v AS (SELECT l_orderkey AS view_id, o_custkey AS user_id, l_shipdate AS view_ts
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

# Snapshots s and the feature view f at each of them.
MOMENT_SQL = "s AS (SELECT TIMESTAMP '2024-01-20' AS event_timestamp)"
DAYS_SQL = """
s AS (SELECT CAST(d AS TIMESTAMP) AS event_timestamp
      FROM generate_series(TIMESTAMP '2024-01-02', TIMESTAMP '2024-01-30',
                           INTERVAL 1 DAY) g(d))"""
MONTHS_SQL = """
s AS (SELECT CAST(d AS TIMESTAMP) AS event_timestamp
      FROM generate_series(TIMESTAMP '1995-02-01', TIMESTAMP '2001-07-01',
                           INTERVAL 1 MONTH) g(d))"""
STATS_SQL = """
so AS (SELECT u.user_id, s.event_timestamp,
              count(*) FILTER (WHERE o.order_ts >= s.event_timestamp - INTERVAL 30 DAY) AS n,
              sum(o.total_amount) FILTER (WHERE o.order_ts >= s.event_timestamp - INTERVAL 30 DAY)
                  AS amount,
              max(o.order_ts) AS last_ts
       FROM u JOIN s ON u.signup_ts < s.event_timestamp
              JOIN o ON o.user_id = u.user_id AND o.order_ts < s.event_timestamp
       GROUP BY ALL),
sv AS (SELECT v.user_id, s.event_timestamp, count(*) AS n
       FROM s JOIN v ON v.view_ts < s.event_timestamp
                    AND v.view_ts >= s.event_timestamp - INTERVAL 7 DAY
       GROUP BY ALL),
f AS (SELECT u.user_id AS entity_id, s.event_timestamp,
             coalesce(so.n, 0) AS order_count_30d,
             CAST(so.amount AS DOUBLE) / nullif(so.n, 0) AS avg_order_value_30d,
             (epoch_us(s.event_timestamp) - epoch_us(so.last_ts)) / 86400000000.0
                 AS days_since_last_order,
             coalesce(sv.n, 0) AS view_count_7d
      FROM u JOIN s ON u.signup_ts < s.event_timestamp
      LEFT JOIN so ON so.user_id = u.user_id AND so.event_timestamp = s.event_timestamp
      LEFT JOIN sv ON sv.user_id = u.user_id AND sv.event_timestamp = s.event_timestamp)"""
FEATURES_SQL = """order_count_30d, round(avg_order_value_30d, 6) AS avg_order_value_30d,
       round(days_since_last_order, 6) AS days_since_last_order, view_count_7d"""
# The view f as long values.
LONG_SQL = """
long AS (SELECT entity_id, event_timestamp, t.feature_name, t.value FROM f,
         LATERAL (VALUES ('order_count_30d', CAST(order_count_30d AS DOUBLE)),
                         ('avg_order_value_30d', avg_order_value_30d),
                         ('days_since_last_order', CAST(days_since_last_order AS DOUBLE)),
                         ('view_count_7d', CAST(view_count_7d AS DOUBLE))) t(feature_name, value))"""

EVENT_DAYS = f"WITH {EVENTS_SQL}, {DAYS_SQL}, {STATS_SQL}"
TRADE_MONTHS = f"WITH {TRADE_SQL}, {MONTHS_SQL}, {STATS_SQL}"
