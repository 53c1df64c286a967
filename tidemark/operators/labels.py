"""Labels: what happened to an entity after a moment."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.time import MICROSECOND, forward, from_epoch_micros, moment, within_days
from tidemark.functions.snapshots import micros_array
from tidemark.session import spread_by

def bought_within(
    users: DataFrame, orders: DataFrame, snapshots: Sequence[datetime], horizon: timedelta
) -> DataFrame:
    """`entity_id, event_timestamp, label` for every snapshot and user who signed up before it.

    The label is 1 with an order in `[snapshot, snapshot + horizon)`. Features read events before
    the snapshot, so no order is both. Users and the snapshots their orders fall into are stacked
    and grouped by user, combined on the map side; the snapshots with an order are bits of a few
    numbers. A user becomes a row per snapshot after that, so those rows are not shuffled.
    """
    if not snapshots:
        raise ValueError("no snapshots to label")
    first, last = min(snapshots), max(snapshots)
    span = horizon // MICROSECOND
    moments = micros_array(snapshots)
    known = users.where(F.col("signup_ts") < F.lit(moment(last))).select(
        F.col("user_id").alias("entity_id"), F.unix_micros("signup_ts").alias("signup")
    )
    ordered = F.unix_micros(F.col("order_ts"))
    within = within_days(orders, "order_date", first, last + horizon).where(
        (F.col("order_ts") >= F.lit(moment(first))) & (F.col("order_ts") < F.lit(last + horizon))
    )
    bought = within.select(
        F.col("user_id").alias("entity_id"),
        F.explode(F.filter(moments, lambda at: (at <= ordered) & (ordered < at + span))).alias("at"),
    ).select("entity_id", (F.array_position(moments, F.col("at")) - 1).alias("number"))
    words = [
        F.bit_or(
            F.when(F.expr(f"number div 64 = {word}"), F.expr("shiftleft(1L, int(number % 64))"))
        ).alias(f"word_{word}")
        for word in range(-(-len(set(snapshots)) // 64))
    ]
    by_user = (
        known.unionByName(bought, allowMissingColumns=True)
        .groupBy("entity_id")
        .agg(F.min("signup").alias("signup"), *words)
        .where(F.col("signup").isNotNull())
    )
    found = F.array(*[F.coalesce(f"word_{word}", F.lit(0)) for word in range(len(words))])
    return (
        by_user.select("entity_id", "signup", found.alias("words"))
        .transform(spread_by, "entity_id")
        .select("entity_id", "signup", "words", F.posexplode(moments).alias("number", "at"))
        .where(F.col("at") > F.col("signup"))
        .select(
            "entity_id",
            F.timestamp_micros("at").alias("event_timestamp"),
            F.expr("int(shiftright(words[number div 64], number % 64) & 1L)").alias("label"),
        )
    )


def buyers(orders: DataFrame, as_of: datetime, horizon: timedelta) -> DataFrame:
    """The entities with label 1 at one moment."""
    orders = within_days(orders, "order_date", moment(as_of), as_of + horizon)
    within = orders.where(forward(F.col("order_ts"), as_of, horizon))
    return within.select(F.col("user_id").alias("entity_id")).distinct()


def require_final(orders: DataFrame, snapshots: Sequence[datetime], horizon: timedelta) -> None:
    """Raise unless the data covers the label window of every snapshot.

    One order at or after the end of the last window is proof enough and stops the look; the end
    of the data is only searched for the message.
    """
    needed = max(moment(snapshot) for snapshot in snapshots) + horizon
    later = within_days(orders, "order_date", needed).where(F.col("order_ts") >= F.lit(needed))
    if not later.isEmpty():
        return
    data_end = orders.agg(F.max(F.unix_micros("order_ts")).alias("end")).first()["end"]
    end = None if data_end is None else from_epoch_micros(data_end)
    open_at = min(at for at in snapshots if end is None or at + horizon > end)
    raise ValueError(
        f"Labels for {open_at.date()} are not final: they need data up to "
        f"{(open_at + horizon).date()}, but the raw data ends at {end or 'nothing'}"
    )
