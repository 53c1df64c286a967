"""The feature view `user_purchase_stats`: recent ordering and browsing per user.

Features read events strictly before the moment, in half-open windows `[as_of - w, as_of)`.
Counts are 0 without events; the mean order value and the days since the last order stay null.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.snapshots import snapshot_array
from tidemark.functions.time import (
    MICROS_PER_DAY,
    day_number,
    days_between,
    epoch_micros,
    moment,
    trailing,
    within_days,
)
from tidemark.session import spread_by
from tidemark.sources.adapters import Commerce

VIEW = "user_purchase_stats"
FEATURES = ["order_count_30d", "avg_order_value_30d", "days_since_last_order", "view_count_7d"]
ORDER_DAYS = 30
VIEW_DAYS = 7

# The same view as SQL over the raw tables, with the moment as parameter `as_of`. What compares
# events with the moment is in the inner selects, where Spark can run it for many moments at once.
SQL = """
SELECT user_id AS entity_id,
       count_if(recent) AS order_count_30d,
       try_divide(CAST(sum(total_amount) FILTER (WHERE recent) AS DOUBLE), count_if(recent))
           AS avg_order_value_30d,
       min(days_since) AS days_since_last_order,
       count_if(viewed) AS view_count_7d
FROM (SELECT user_id, true AS known, false AS recent, CAST(null AS DECIMAL(12,2)) AS total_amount,
             CAST(null AS DOUBLE) AS days_since, false AS viewed
      FROM users WHERE signup_ts < :as_of
      UNION ALL
      SELECT user_id, null, order_ts >= :as_of - INTERVAL '30' DAY, total_amount,
             (unix_micros(:as_of) - unix_micros(order_ts)) / 86400000000D, false
      FROM orders WHERE order_ts < :as_of
      UNION ALL
      SELECT user_id, null, false, null, null, true FROM product_views
      WHERE view_ts < :as_of AND view_ts >= :as_of - INTERVAL '7' DAY)
GROUP BY user_id
HAVING max(known)
"""


def purchase_stats(
    commerce: Commerce,
    as_of: datetime,
    order_days: int = ORDER_DAYS,
    view_days: int = VIEW_DAYS,
) -> DataFrame:
    """The view as of one moment: one row per user who signed up before it.

    Users, orders and views are stacked and grouped once, which is the left join of the user
    list with both aggregates in a single shuffle. Grouping combines on the map side, so a user
    with a large part of all events arrives as one partial row per task.
    """
    moment(as_of)
    recent = trailing(F.col("order_ts"), as_of, timedelta(days=order_days))
    views_since = as_of - timedelta(days=view_days)

    users = commerce.users.where(F.col("signup_ts") < F.lit(as_of))
    orders = within_days(commerce.orders, "order_date", until=as_of)
    views = within_days(commerce.product_views, "view_date", views_since, as_of)
    facts = (
        users.select("user_id", F.lit(True).alias("known"))
        .unionByName(
            orders.where(F.col("order_ts") < F.lit(as_of)).select(
                "user_id", "order_ts", "total_amount"
            ),
            allowMissingColumns=True,
        )
        .unionByName(
            views.where(trailing(F.col("view_ts"), as_of, timedelta(days=view_days))).select(
                "user_id", "view_ts"
            ),
            allowMissingColumns=True,
        )
    )
    stats = facts.groupBy("user_id").agg(
        F.max("known").alias("known"),
        F.count_if(recent).alias("orders"),
        F.sum(F.when(recent, F.col("total_amount"))).alias("amount"),
        F.max("order_ts").alias("last_order"),
        F.count("view_ts").alias("views"),
    )
    return stats.where("known").select(
        F.col("user_id").alias("entity_id"),
        *feature_columns(F.lit(as_of), order_days, view_days),
    )


def feature_columns(
    at: Column, order_days: int = ORDER_DAYS, view_days: int = VIEW_DAYS
) -> list[Column]:
    """The features out of `orders`, `amount`, `last_order` and `views` of a user at a moment."""
    return [
        F.col("orders").alias(f"order_count_{order_days}d"),
        F.try_divide(F.col("amount").cast("double"), F.col("orders")).alias(
            f"avg_order_value_{order_days}d"
        ),
        days_between(at, F.col("last_order")).alias("days_since_last_order"),
        F.col("views").alias(f"view_count_{view_days}d"),
    ]


def _trailing_days(snapshots: Sequence[datetime], window_days: int) -> list[int]:
    """The days that lie in the trailing window of some midnight."""
    numbers = {epoch_micros(snapshot) // MICROS_PER_DAY for snapshot in snapshots}
    return sorted({number - back for number in numbers for back in range(1, window_days + 1)})


def purchase_stats_at(
    commerce: Commerce,
    snapshots: Sequence[datetime],
    order_days: int = ORDER_DAYS,
    view_days: int = VIEW_DAYS,
) -> DataFrame:
    """The view at many midnights in one pass: a row per snapshot and user known by then.

    Events are first reduced to one row per user and day, so what reaches a user's window grows
    with the number of days and not with the number of events, however many one user has. Views on
    days that no window holds are left out before that. A user travels as one row and becomes a row
    per snapshot where the days of the user are.
    """
    if not snapshots:
        raise ValueError("no snapshots to compute")
    if any(epoch_micros(moment(snapshot)) % MICROS_PER_DAY for snapshot in snapshots):
        raise ValueError("snapshots must be at midnight UTC; use purchase_stats for other moments")
    first, last = min(snapshots), max(snapshots)
    views_since = first - timedelta(days=view_days)

    users = commerce.users.where(F.col("signup_ts") < F.lit(last)).select("user_id", "signup_ts")
    orders = within_days(commerce.orders, "order_date", until=last)
    daily_orders = (
        orders.where(F.col("order_ts") < F.lit(last))
        .groupBy("user_id", day_number(F.col("order_ts")).alias("day"))
        .agg(
            F.count(F.lit(1)).alias("day_orders"),
            F.sum("total_amount").alias("day_amount"),
            F.max("order_ts").alias("day_last"),
        )
    )
    views = within_days(commerce.product_views, "view_date", views_since, last)
    daily_views = (
        views.where((F.col("view_ts") < F.lit(last)) & (F.col("view_ts") >= F.lit(views_since)))
        .where(day_number(F.col("view_ts")).isin(_trailing_days(snapshots, view_days)))
        .groupBy("user_id", day_number(F.col("view_ts")).alias("day"))
        .agg(F.count(F.lit(1)).alias("day_views"))
    )
    known = F.col("signup_ts").isNotNull()
    moments = snapshot_array(snapshots, lambda at: at > F.unix_micros(F.col("signup_ts")))
    days = (
        users.unionByName(daily_orders, allowMissingColumns=True)
        .unionByName(daily_views, allowMissingColumns=True)
        .transform(spread_by, "user_id")
        .withColumn("event_timestamp", F.explode_outer(F.when(known, moments)))
        .withColumn("day", F.coalesce("day", day_number(F.col("event_timestamp"))))
    )
    by_day = Window.partitionBy("user_id").orderBy("day")

    def before(window_days: int) -> Window:
        return by_day.rangeBetween(Window.unboundedPreceding, -1 - window_days)

    def within(column: str, window_days: int) -> Column:
        """A total over a trailing window, as the difference of two running totals."""
        total = F.coalesce(F.sum(column).over(before(0)), F.lit(0))
        return total - F.coalesce(F.sum(column).over(before(window_days)), F.lit(0))

    stats = days.select(
        "user_id",
        "event_timestamp",
        within("day_orders", order_days).alias("orders"),
        within("day_amount", order_days).alias("amount"),
        F.max("day_last").over(before(0)).alias("last_order"),
        within("day_views", view_days).alias("views"),
    )
    return stats.where(F.col("event_timestamp").isNotNull()).select(
        F.col("user_id").alias("entity_id"),
        "event_timestamp",
        *feature_columns(F.col("event_timestamp"), order_days, view_days),
    )
