"""The purchase statistics carried on from day to day, and mended where late events belong.

`RollingStats` keeps, besides the values, what a user did on each of the last days and the totals
of the windows as of the last midnight. The next midnight adds one day and takes away the days that
leave the windows, so it reads one day of raw events, however long the history is.

`apply_late` finds the users and days whose windows hold an event of an added load, and computes
these alone.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from datetime import date, datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.time import midnight, within_days
from tidemark.plans.compute import view_values
from tidemark.plans.purchase_stats import (
    ORDER_DAYS,
    VIEW,
    VIEW_DAYS,
    feature_columns,
    purchase_stats_at,
)
from tidemark.plans.store import FeatureStore
from tidemark.session import cut
from tidemark.sources import schemas
from tidemark.sources.adapters import Commerce
from tidemark.sources.manifest import Manifest, Storage

DAY = timedelta(days=1)
STATE, ACTIVITY = "state", "activity"
# Users or pairs that are broadcast at most (about 16 bytes each); beyond, Spark shuffles.
BROADCAST_ROWS = 1_000_000
# Features that orders decide; the others are decided by views.
ORDER_FEATURES = ["order_count_30d", "avg_order_value_30d", "days_since_last_order"]

_AMOUNT = T.DecimalType(28, 2)
_ACTIVITY = "user_id bigint, orders bigint, amount decimal(28,2), last_order timestamp, views bigint"
_TOTALS = "user_id bigint, known boolean, orders bigint, amount decimal(28,2), last_order timestamp, views bigint"


def _of_days(frame: DataFrame, column: str, ts: str, since: date | None, until: date) -> DataFrame:
    """Events from one midnight to another, reading their days only."""
    start = None if since is None else midnight(since)
    days = within_days(frame, column, start, midnight(until - DAY))
    days = days.where(F.col(ts) < F.lit(midnight(until)))
    return days if start is None else days.where(F.col(ts) >= F.lit(start))


def activity(commerce: Commerce, since: date | None, until: date) -> DataFrame:
    """What each user did on each day from `since` (or ever) to before `until`."""
    orders = _of_days(commerce.orders, "order_date", "order_ts", since, until).select(
        "user_id", F.to_date("order_ts").alias("day"), "order_ts", "total_amount"
    )
    views = _of_days(commerce.product_views, "view_date", "view_ts", since, until).select(
        "user_id", F.to_date("view_ts").alias("day"), "view_ts"
    )
    return (
        orders.unionByName(views, allowMissingColumns=True)
        .groupBy("user_id", "day")
        .agg(
            F.count("order_ts").alias("orders"),
            F.sum("total_amount").cast(_AMOUNT).alias("amount"),
            F.max("order_ts").alias("last_order"),
            F.count("view_ts").alias("views"),
        )
    )


def _part(rows: DataFrame, sign: int, orders: Column, views: Column) -> DataFrame:
    """Rows of activity as changes of the totals: their orders and views where these count."""
    return rows.select(
        "user_id",
        F.when(orders, sign * F.col("orders")).alias("orders"),
        F.when(orders, sign * F.col("amount")).alias("amount"),
        (F.col("last_order") if sign > 0 else F.lit(None).cast("timestamp")).alias("last_order"),
        F.when(views, sign * F.col("views")).alias("views"),
    )


def _summed(parts: Iterable[DataFrame]) -> DataFrame:
    """Totals of the users out of changes; users that are known or were seen once stay."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return stacked.groupBy("user_id").agg(
        F.coalesce(F.max("known"), F.lit(False)).alias("known"),
        F.coalesce(F.sum("orders"), F.lit(0)).alias("orders"),
        F.coalesce(F.sum("amount"), F.lit(0)).cast(_AMOUNT).alias("amount"),
        F.max("last_order").alias("last_order"),
        F.coalesce(F.sum("views"), F.lit(0)).alias("views"),
    )


class RollingStats:
    """Totals of the windows as of the last computed midnight, and the days they are made of."""

    def __init__(self, store: FeatureStore, order_days: int = ORDER_DAYS, view_days: int = VIEW_DAYS):
        self.store = store
        self.order_days, self.view_days = order_days, view_days
        self.path = f"{store.root}/rolling/{VIEW}"
        self.manifest = Manifest(store.spark, f"{self.path}/manifest")

    def as_of(self) -> date | None:
        """The midnight that the totals stand at."""
        found = [folder["day"] for folder in self.manifest.current()[1] if folder["kind"] == STATE]
        return date.fromisoformat(found[0]) if found else None

    def totals(self) -> DataFrame:
        [folder] = [f for f in self.manifest.current()[1] if f["kind"] == STATE]
        return self._read(_TOTALS, [folder["path"]])

    def _read(self, schema: str, paths: list[str]) -> DataFrame:
        if not paths:
            return self.store.spark.createDataFrame([], schema)
        return self.store.spark.read.schema(schema).parquet(*[f"{self.path}/{p}" for p in paths])

    def _days(self, folders: list[dict], wanted: Iterable[date]) -> DataFrame:
        """The activity of these days; a day without any has no folder."""
        names = {day.isoformat() for day in wanted}
        found = self._read(_ACTIVITY, []).withColumn("day", F.lit(None).cast("date"))
        for folder in folders:
            if folder["kind"] == ACTIVITY and folder["day"] in names and folder["path"]:
                rows = self._read(_ACTIVITY, [folder["path"]])
                found = found.unionByName(rows.withColumn("day", F.lit(folder["day"]).cast("date")))
        return found

    def _put_days(self, rows: DataFrame, version: int, days: Iterable[date]) -> list[dict]:
        """Write the activity of some days; returns their folders."""
        path = f"v={version}/{ACTIVITY}"
        rows.hint("rebalance", F.col("day")).write.mode("overwrite").option(
            "partitionOverwriteMode", "static"
        ).partitionBy("day").parquet(f"{self.path}/{path}")
        written = Storage(self.store.spark, self.path).names(path)
        return [
            {
                "kind": ACTIVITY,
                "day": day.isoformat(),
                "path": f"{path}/day={day}" if f"day={day}" in written else "",
            }
            for day in days
        ]

    def _put_state(self, totals: DataFrame, version: int, as_of: date) -> dict:
        path = f"v={version}/{STATE}"
        totals.write.mode("overwrite").parquet(f"{self.path}/{path}")
        return {"kind": STATE, "day": as_of.isoformat(), "path": path}

    def start(self, as_of: date, now: datetime | None = None) -> int:
        """Totals as of a midnight out of the whole history; returns the values written."""
        raw = self.store.raw.read()
        version, _ = self.manifest.current()
        since = as_of - self.order_days * DAY
        recent = cut(activity(raw, since, as_of))
        days = [since + number * DAY for number in range(self.order_days)]
        folders = self._put_days(recent, version + 1, days)
        older = within_days(raw.orders, "order_date", until=midnight(since)).where(
            F.col("order_ts") < F.lit(midnight(since))
        )
        first_view = as_of - self.view_days * DAY
        totals = _summed(
            [
                self._users(raw, as_of),
                _part(recent, 1, F.lit(True), F.col("day") >= F.lit(first_view)),
                older.groupBy("user_id").agg(F.max("order_ts").alias("last_order")),
            ]
        )
        return self._commit(totals, as_of, version + 1, folders, now)

    def advance(self, now: datetime | None = None) -> int:
        """The next midnight out of the last one and a day of events; the values written."""
        raw = self.store.raw.read()
        version, folders = self.manifest.current()
        day = self.as_of()
        if day is None:
            raise LookupError("start the totals first")
        as_of = day + DAY
        days = [folder for folder in folders if folder["kind"] == ACTIVITY]
        today = cut(activity(raw, day, as_of))
        # What leaves the windows: one day of each
        leaving = {
            "orders": day - self.order_days * DAY,
            "views": day - self.view_days * DAY,
        }
        gone = self._days(days, set(leaving.values()))
        of = lambda name: F.col("day") == F.lit(leaving[name])
        totals = _summed(
            [
                self.totals(),
                self._users(raw, as_of),
                _part(today, 1, F.lit(True), F.lit(True)),
                _part(gone, -1, of("orders"), of("views")),
            ]
        )
        first = (as_of - self.order_days * DAY).isoformat()
        kept = [folder for folder in days if folder["day"] >= first]
        kept += self._put_days(today, version + 1, [day])
        return self._commit(totals, as_of, version + 1, kept, now)

    @staticmethod
    def _users(raw: Commerce, as_of: date) -> DataFrame:
        known = raw.users.where(F.col("signup_ts") < F.lit(midnight(as_of)))
        return known.select("user_id", F.lit(True).alias("known"))

    def _commit(self, totals, as_of: date, version: int, days: list[dict], now) -> int:
        """Write the totals and their values. Values come first: a second try writes them again."""
        state = self._put_state(totals, version, as_of)
        stored = self._read(_TOTALS, [state["path"]])
        names = [f.feature_name for f in self.store.registry.in_use(VIEW)]
        at = F.lit(midnight(as_of))
        wide = stored.where("known").select(
            F.col("user_id").alias("entity_id"),
            *feature_columns(at, self.order_days, self.view_days),
        )
        written = self.store.values.upsert(view_values(wide, VIEW, names, midnight(as_of)), now)
        self.manifest.commit(version, [*days, state])
        return written

    def absorb(self, load: int) -> None:
        """Add the late events of a load to the days and totals, before the next `advance`."""
        version, folders = self.manifest.current()
        as_of = self.as_of()
        rows = self.store.raw.added(load)
        if as_of is None or not {"orders", "product_views"} & set(rows):
            return
        raw = self.store.raw.read()
        empty = Commerce(raw.users, raw.orders.limit(0), raw.product_views.limit(0))
        late = Commerce(
            raw.users,
            rows.get("orders", empty.orders),
            rows.get("product_views", empty.product_views),
        )
        brought = cut(activity(late, None, as_of))
        days = [folder for folder in folders if folder["kind"] == ACTIVITY]
        first, first_view = as_of - self.order_days * DAY, as_of - self.view_days * DAY
        touched = {row["day"] for row in brought.select("day").distinct().collect()}
        touched = sorted(day for day in touched if day >= first)
        kept = [folder for folder in days if date.fromisoformat(folder["day"]) not in touched]
        both = self._days(days, touched).unionByName(brought.where(F.col("day") >= F.lit(first)))
        merged = both.groupBy("user_id", "day").agg(
            F.sum("orders").alias("orders"),
            F.sum("amount").cast(_AMOUNT).alias("amount"),
            F.max("last_order").alias("last_order"),
            F.sum("views").alias("views"),
        )
        kept += self._put_days(merged, version + 1, touched)
        day = F.col("day")
        part = _part(brought, 1, day >= F.lit(first), day >= F.lit(first_view))
        state = self._put_state(_summed([self.totals(), part]), version + 1, as_of)
        self.manifest.commit(version + 1, [*kept, state])


@dataclass(frozen=True)
class LateResult:
    """How many (user, midnight) pairs were computed again, and how many values changed."""

    pairs: int
    written: int


def _listed(rows: DataFrame) -> DataFrame:
    return F.broadcast(rows) if rows.count() <= BROADCAST_ROWS else rows


def late_pairs(store: FeatureStore, load: int, computed: list[date]) -> DataFrame:
    """`entity_id, snapshot_date, kind, since`: the midnights whose windows hold an event of a load,
    and the first day with such an event.

    An order counts for `ORDER_DAYS` midnights after it, and as the last order until the user's
    next one; a view for `VIEW_DAYS`.
    """
    rows = store.raw.added(load)
    spark, last = store.spark, F.lit(max(computed))
    found = [
        spark.createDataFrame([], "entity_id bigint, day date, first date, final date, kind string")
    ]
    if "orders" in rows:
        touched = cut(
            rows["orders"].select("user_id", F.to_date("order_ts").alias("day")).distinct()
        )
        since = touched.agg(F.min("day")).first()[0]
        if since is not None:
            users = _listed(touched.select("user_id").distinct())
            days = within_days(store.raw.read().orders, "order_date", midnight(since))
            own = (
                days.join(users, "user_id", "left_semi")
                .select("user_id", F.to_date("order_ts").alias("day"))
                .where(F.col("day") >= F.lit(since))
                .distinct()
            )
            by_user = Window.partitionBy("user_id").orderBy("day")
            following = own.withColumn("next", F.lead("day").over(by_user))
            final = F.greatest(F.date_add("day", ORDER_DAYS), F.coalesce("next", last))
            found.append(
                following.join(touched, ["user_id", "day"], "left_semi").select(
                    F.col("user_id").alias("entity_id"),
                    "day",
                    F.date_add("day", 1).alias("first"),
                    final.alias("final"),
                    F.lit("order").alias("kind"),
                )
            )
    if "product_views" in rows:
        views = rows["product_views"].select("user_id", F.to_date("view_ts").alias("day")).distinct()
        found.append(
            views.select(
                F.col("user_id").alias("entity_id"),
                "day",
                F.date_add("day", 1).alias("first"),
                F.date_add("day", VIEW_DAYS).alias("final"),
                F.lit("view").alias("kind"),
            )
        )
    spans = reduce(DataFrame.unionByName, found).withColumn("final", F.least("final", last))
    midnights = F.explode(F.sequence("first", "final")).alias("snapshot_date")
    return (
        spans.where(F.col("first") <= F.col("final"))
        .select("entity_id", "day", midnights, "kind")
        .where(F.col("snapshot_date").isin(computed))
        .groupBy("entity_id", "snapshot_date", "kind")
        .agg(F.min("day").alias("since"))
    )


def late_commerce(store: FeatureStore, pairs: DataFrame) -> Commerce:
    """The raw rows that decide these pairs: events of their users in the days of their windows.

    The last order of a midnight is a late one or comes after it, so events before the first late
    one are read for the windows only.
    """
    per_kind = pairs.groupBy("kind").agg(
        F.min("snapshot_date").alias("first"),
        F.max("snapshot_date").alias("last"),
        F.min("since").alias("since"),
    )
    bounds = {row["kind"]: row for row in per_kind.collect()}
    raw = store.raw.read()
    users = _listed(pairs.select(F.col("entity_id").alias("user_id")).distinct())

    def own(frame: DataFrame, kind: str, column: str, days: int) -> DataFrame:
        if kind not in bounds:
            return frame.limit(0)
        first = min(bounds[kind]["first"] - days * DAY, bounds[kind]["since"])
        within = within_days(frame, column, midnight(first), midnight(bounds[kind]["last"]))
        return within.join(users, "user_id", "left_semi")

    return Commerce(
        users=raw.users.join(users, "user_id", "left_semi"),
        orders=own(raw.orders, "order", "order_date", ORDER_DAYS),
        product_views=own(raw.product_views, "view", "view_date", VIEW_DAYS),
    )


def apply_late(store: FeatureStore, load: int, now: datetime | None = None) -> LateResult:
    """Compute again what the events of an added load change in the stored values.

    Only users with such an event are read, in the days of the windows that hold one, and only
    partitions in which a value changes are written. Users must be loaded in full before.
    """
    computed = [date.fromisoformat(folder["day"]) for folder in store.values.folders(VIEW)]
    if not computed:
        return LateResult(0, 0)
    pairs = cut(late_pairs(store, load, computed))
    n_pairs = pairs.count()
    if not n_pairs:
        return LateResult(0, 0)
    wanted = [row[0] for row in pairs.select("snapshot_date").distinct().collect()]
    wide = purchase_stats_at(late_commerce(store, pairs), [midnight(day) for day in sorted(wanted)])
    names = [f.feature_name for f in store.registry.in_use(VIEW)]
    values = view_values(wide, VIEW, names, F.col("event_timestamp"))
    kind = F.when(F.col("feature_name").isin(ORDER_FEATURES), "order").otherwise("view")
    keyed = values.withColumn("snapshot_date", F.to_date("event_timestamp")).withColumn("kind", kind)
    changed = keyed.join(pairs, ["entity_id", "snapshot_date", "kind"], "left_semi")
    written = store.values.upsert(changed.select(*values.columns), now)
    return LateResult(n_pairs, written)
