"""Keep only the stored values that some request could see, before anything is shuffled."""

from __future__ import annotations

from collections.abc import Collection, Iterable, Mapping
from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Up to this many (entity, day) pairs are broadcast; more are shuffled, with the values.
BROADCAST_PAIRS = 1_000_000
DAY = timedelta(days=1)
# Days of a longer validity are not listed one by one: its values are cut by entity only.
LONGEST_TTL = timedelta(days=400)


def days_back(ttl: timedelta) -> int:
    """Calendar days before the request's own day that a ttl can reach into."""
    return -(-ttl // DAY)


def request_days(requests: DataFrame) -> tuple[dict[date, int], int]:
    """The days of the requests in order, each with about how many entities ask on it, and how
    many requests there are.

    One small aggregation; at most one row per calendar day comes back.
    """
    day = F.to_date("event_timestamp").alias("day")
    found = (
        requests.groupBy(day)
        .agg(F.approx_count_distinct("entity_id").alias("entities"), F.count(F.lit(1)).alias("n"))
        .collect()
    )
    days = {row["day"]: row["entities"] for row in found if row["day"] is not None}
    return dict(sorted(days.items())), sum(row["n"] for row in found)


def visible_days(days: Iterable[date], ttl: timedelta | None) -> list[date] | None:
    """The days whose values can be valid on the given days; None stands for every earlier day."""
    if ttl is None or ttl > LONGEST_TTL:
        return None
    return sorted(
        {
            day - n * DAY
            for day in days
            for n in range(min(days_back(ttl), (day - date.min).days) + 1)
        }
    )


def on_visible_days(
    values: DataFrame, days: Collection[date], ttls: Mapping[str, timedelta | None], group: str
) -> DataFrame:
    """Bound the `snapshot_date` partitions: `ttls` gives the ttl for each value of `group`."""
    if not days:
        return values.where(F.lit(False))
    wanted = F.lit(False)
    for name, ttl in ttls.items():
        visible = visible_days(days, ttl)
        in_time = (
            F.col("snapshot_date") <= F.lit(max(days))
            if visible is None
            else F.col("snapshot_date").isin(visible)
        )
        wanted = wanted | ((F.col(group) == name) & in_time)
    return values.where(wanted)


def near_requests(
    values: DataFrame,
    requests: DataFrame,
    days: Mapping[date, int],
    ttl: timedelta | None,
    limit: int = BROADCAST_PAIRS,
) -> DataFrame:
    """Keep the values of requested entities (within reach of a requested day, with a ttl).

    `days` comes from `request_days`. It is a semi join: a value is kept once, however many
    requests could see it. The requested (entity, day) pairs are broadcast up to about `limit`.
    """
    if ttl is not None and ttl > LONGEST_TTL:
        ttl = None
    reach = 1 if ttl is None else days_back(ttl) + 1
    day = F.to_date("event_timestamp")
    if ttl is None:
        keys, wanted = ["entity_id"], requests.select("entity_id").distinct()
    else:
        asked = F.sequence(F.date_sub(day, reach - 1), day)
        keys = ["entity_id", "_day"]
        wanted = requests.select("entity_id", F.explode(asked).alias("_day")).distinct()
    if sum(days.values()) * reach <= limit:
        wanted = F.broadcast(wanted)
    near = values.withColumn("_day", day).join(wanted, keys, "left_semi")
    return near.select(*values.columns)
