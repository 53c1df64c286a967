"""The offline store: every computed value of every feature over time."""

from __future__ import annotations

from collections.abc import Collection, Iterable
from datetime import UTC, date, datetime, timedelta
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.values import null_if_nan
from tidemark.operators.upsert import merge_values
from tidemark.session import cut, discard
from tidemark.sources import schemas
from tidemark.sources.manifest import Manifest, Storage
from tidemark.sources.tables import nullable

PARTITIONS = ["view_name", "snapshot_date"]
# Folders of a table: values of one day, the last values before the first of a month, or how often
# each value of a feature occurs on one day.
DAY, STATE, COUNTS = "day", "state", "counts"
_COUNTED = T.StructType(
    [
        T.StructField("feature_name", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("n", T.LongType()),
        T.StructField("version", T.LongType()),
        T.StructField("view_name", T.StringType()),
        T.StructField("snapshot_date", T.DateType()),
    ]
)


def month_start(day: date) -> date:
    return day.replace(day=1)


def next_month(day: date) -> date:
    return date(day.year + day.month // 12, day.month % 12 + 1, 1)


class ValueStore:
    """Long values in Parquet, partitioned by view and by the day of their timestamp.

    A snapshot, a validity window or a range of days reads only its own partitions; new features
    need no rewrite of old data. A partition that changes is written again under a new version. A
    manifest lists the folders that count: readers take one list and see all of a commit or nothing,
    a writer that dies leaves nothing behind that is read, and neither the plan nor the cost of a
    read grows with the number of commits. `vacuum` removes what no list of late names.

    Views whose values never expire may have states: for the first of a month, the last value of
    every entity and feature before it. `as_known` reads a state and the days since. Days may have
    the counts of their values, which add up to those of any range of days.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.path = f"{root}/feature_values"
        self.counts_path = f"{root}/feature_value_counts"
        self.manifest = Manifest(spark, f"{root}/feature_value_manifest")
        self.schema = T.StructType(
            [*nullable(schemas.FEATURE_VALUES).fields, T.StructField("snapshot_date", T.DateType())]
        )

    # Reading

    def folders(
        self,
        view_name: str | None = None,
        since: date | None = None,
        until: date | None = None,
        kind: str = DAY,
    ) -> list[dict]:
        """The live folders of a view in a range of days; each names its day, path and rows."""
        return [
            folder
            for folder in self.manifest.current()[1]
            if folder["kind"] == kind
            and (view_name is None or folder["view"] == view_name)
            and (since is None or folder["day"] >= since.isoformat())
            and (until is None or folder["day"] <= until.isoformat())
        ]

    def read(
        self, view_name: str | None = None, since: date | None = None, until: date | None = None
    ) -> DataFrame:
        """All values, or those of a view or of a range of days."""
        return self._read(self.folders(view_name, since, until))

    def _read(self, folders: Collection[dict]) -> DataFrame:
        stored = T.StructType([*self.schema.fields, T.StructField("version", T.LongType())])
        return self._folders_of(self.path, stored, folders).select(*self.schema.names)

    def _folders_of(self, root: str, schema: T.StructType, folders: Collection[dict]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], schema)
        by_version: dict[str, list[dict]] = {}
        for folder in folders:
            by_version.setdefault(folder["path"].partition("/")[0], []).append(folder)
        paths = []
        for version, own in by_version.items():
            # A version that counts as a whole is one path
            whole = len(own) == own[0]["of"]
            paths += [version] if whole else [folder["path"] for folder in own]
        reader = self.spark.read.schema(schema).option("basePath", root)
        return reader.parquet(*[f"{root}/{path}" for path in paths])

    def snapshot(self, as_of: datetime, view_name: str | None = None) -> DataFrame:
        """The values stamped exactly `as_of`."""
        day = as_of.astimezone(UTC).date()
        return self.read(view_name, day, day).where(
            (F.col("snapshot_date") == F.lit(day)) & (F.col("event_timestamp") == F.lit(as_of))
        )

    def until(self, as_of: datetime, view_name: str | None = None, ttl=None) -> DataFrame:
        """The values up to `as_of`, and not older than the ttl where there is one."""
        bound = as_of.astimezone(UTC)
        since = None if ttl is None else (bound - ttl).date()
        values = self.read(view_name, since, bound.date()).where(
            (F.col("snapshot_date") <= F.lit(bound.date()))
            & (F.col("event_timestamp") <= F.lit(as_of))
        )
        if view_name is not None:
            values = values.where(F.col("view_name") == view_name)
        if ttl is None:
            return values
        return values.where(
            (F.col("snapshot_date") >= F.lit(since)) & (F.col("event_timestamp") >= F.lit(as_of - ttl))
        )

    def as_known(self, view_name: str, days: Iterable[date]) -> DataFrame:
        """Values among which the last one before any moment of these days is, for every entity.

        For each month asked for, that is its state and the days from there to the last one asked
        for; without a state, an earlier one and the days since.
        """
        states = {folder["day"]: folder for folder in self.folders(view_name, kind=STATE)}
        by_month: dict[date, date] = {}
        for day in days:
            month = month_start(day)
            by_month[month] = max(day, by_month.get(month, day))
        chosen: dict[str, dict] = {}
        for month, last in by_month.items():
            state = max((at for at in states if at <= month.isoformat()), default=None)
            since = None
            if state is not None:
                chosen[states[state]["path"]] = states[state]
                since = date.fromisoformat(state)
            for folder in self.folders(view_name, since, last):
                chosen[folder["path"]] = folder
        of_kind = {
            kind: self._read([f for f in chosen.values() if f["kind"] == kind])
            for kind in (DAY, STATE)
        }
        # A state is stored under its month; its values keep the day they are from.
        from_state = of_kind[STATE].withColumn("snapshot_date", F.to_date("event_timestamp"))
        return of_kind[DAY].unionByName(from_state)

    # Writing

    def upsert(self, values: DataFrame, now: datetime | None = None) -> int:
        """Insert or update values; returns how many rows were inserted or changed.

        Only the views and days that the values are stamped with are read, and only those in which
        something changed are written again; the same values a second time write nothing. Values
        that were not computed this time stay. States after a day that changed do not count any
        more.
        """
        now = now or datetime.now(UTC)
        version, live = self.manifest.current()
        new = cut(values.withColumn("snapshot_date", F.to_date("event_timestamp")))
        stamped = new.select(*PARTITIONS).distinct()
        days = {(row["view_name"], str(row["snapshot_date"])) for row in stamped.collect()}
        touched = [f for f in live if f["kind"] == DAY and (f["view"], f["day"]) in days]
        merged = cut(
            merge_values(self._read(touched), new, now).withColumn(
                "snapshot_date", F.to_date("event_timestamp")
            )
        )
        try:
            return self._write(merged, version + 1, live)
        finally:
            discard(new, merged)

    def _write(self, merged: DataFrame, version: int, live: list[dict]) -> int:
        written = F.count_if(F.col("change").isin("inserted", "changed"))
        per_partition = merged.groupBy(*PARTITIONS).agg(
            written.alias("written"), F.count(F.lit(1)).alias("n_rows")
        )
        changed = per_partition.where(F.col("written") > 0).collect()
        if not changed:
            return 0
        listed = self.spark.createDataFrame(changed, per_partition.schema)
        rewritten = merged.join(F.broadcast(listed.select(*PARTITIONS)), PARTITIONS, "left_semi")
        rows = {(row["view_name"], str(row["snapshot_date"])): row["n_rows"] for row in changed}
        added = self._added(rewritten, version, DAY, rows)
        first: dict[str, str] = {}
        for view, day in rows:
            first[view] = min(day, first.get(view, day))
        kept = [
            folder
            for folder in live
            if (folder["view"], folder["day"]) not in rows
            if folder["kind"] in (DAY, COUNTS)
        ] + [
            folder
            for folder in live
            if folder["kind"] == STATE and folder["day"] <= first.get(folder["view"], folder["day"])
        ]
        self.manifest.commit(version, kept + added)
        return sum(row["written"] for row in changed)

    def _added(self, rows: DataFrame, version: int, kind: str, counts: dict) -> list[dict]:
        """Write rows as a new version; its folders, with their counts by (view, day) if known."""
        root = self.counts_path if kind == COUNTS else self.path
        names = _COUNTED.names if kind == COUNTS else self.schema.names
        # Rebalancing gives each day few files and splits days that are too large
        rows.select(*[name for name in names if name != "version"]).hint(
            "rebalance", *[F.col(name) for name in PARTITIONS]
        ).write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(
            *PARTITIONS
        ).parquet(f"{root}/version={version}")
        found = []
        for view, days in self._subfolders(root, f"version={version}").items():
            for day in days:
                name, stamp = (unquote(text.partition("=")[2]) for text in (view, day))
                path = f"version={version}/{view}/{day}"
                n_rows = counts.get((name, stamp))
                found.append({"kind": kind, "view": name, "day": stamp, "path": path, "rows": n_rows})
        return [{**folder, "of": len(found)} for folder in found]

    def _subfolders(self, root: str, version: str) -> dict[str, list[str]]:
        storage = Storage(self.spark, root)
        views = [name for name in storage.names(version) if "=" in name]
        return {
            view: [name for name in storage.names(f"{version}/{view}") if "=" in name]
            for view in views
        }

    def count_days(
        self, view_name: str, since: date | None = None, until: date | None = None
    ) -> int:
        """Count the values of the days that have no counts yet, in one pass over these days.

        Returns how many days that were. A day that is written again loses its counts.
        """
        version, live = self.manifest.current()
        counted = {f["day"] for f in self.folders(view_name, since, until, COUNTS)}
        missing = [f for f in self.folders(view_name, since, until) if f["day"] not in counted]
        if missing:
            value = null_if_nan(F.col("value")).alias("value")
            rows = self._read(missing).groupBy(*PARTITIONS, "feature_name", value)
            rows = rows.agg(F.count(F.lit(1)).alias("n"))
            self.manifest.commit(version + 1, live + self._added(rows, version + 1, COUNTS, {}))
        return len(missing)

    def counts(
        self, view_name: str, since: date | None = None, until: date | None = None
    ) -> DataFrame:
        """`feature_name, value, n` over a range of days, added up from the counts of its days.

        Missing values are null. The values themselves are read on days without counts only.
        """
        self.count_days(view_name, since, until)
        days = self.folders(view_name, since, until, COUNTS)
        stored = self._folders_of(self.counts_path, _COUNTED, days)
        return stored.groupBy("feature_name", "value").agg(F.sum("n").alias("n"))

    def advance_states(self, view_name: str, until: date) -> int:
        """Add the states of a view that are missing up to a day; returns how many months.

        All of them come out of one pass over the last state before them and the days since: the
        last value of each month counts from the next month to the one of its successor.
        """
        version, live = self.manifest.current()
        own = [folder for folder in live if folder["view"] == view_name]
        days = sorted(f["day"] for f in own if f["kind"] == DAY)
        states = {f["day"]: f for f in own if f["kind"] == STATE}
        if not days:
            return 0
        months, month = [], next_month(date.fromisoformat(days[0]))
        while month <= until:
            months.append(month)
            month = next_month(month)
        missing = [month for month in months if month.isoformat() not in states]
        if not missing:
            return 0
        base = max((at for at in states if at < missing[0].isoformat()), default="")
        source = self._read(
            [f for f in own if f["kind"] == DAY and base <= f["day"] < missing[-1].isoformat()]
        )
        if base:
            source = source.unionByName(self._read([states[base]]))
        month_of = F.greatest(
            F.trunc("event_timestamp", "month"),
            # What a state brings is older than all months after it
            F.add_months(F.lit(date.fromisoformat(base)), -1) if base else F.lit(None).cast("date"),
        )
        key = ["view_name", "entity_id", "feature_name"]
        last = source.groupBy(*key, month_of.alias("month")).agg(
            F.max_by(F.struct("event_timestamp", "value", "created_at"), "event_timestamp").alias("v")
        )
        successor = F.lead("month").over(Window.partitionBy(*key).orderBy("month"))
        first, final = F.add_months("month", 1), F.least(successor, F.lit(missing[-1]))
        months_of = F.sequence(F.col("first"), F.col("final"), F.expr("INTERVAL 1 MONTH"))
        rows = (
            last.select(*key, "v.*", first.alias("first"), final.alias("final"))
            .where("first <= final")
            .withColumn("snapshot_date", F.explode(months_of))
            .where(F.col("snapshot_date").isin(missing))
        )
        added = self._added(rows, version + 1, STATE, {})
        self.manifest.commit(version + 1, live + added)
        return len(added)

    def vacuum(self, keep: timedelta, now: datetime | None = None) -> int:
        """Remove folders that no commit of the last `keep` lists; returns how many.

        Readers that planned a read longer ago than `keep` may miss files, so `keep` should exceed
        the longest job. Run it from the one writer of the store.
        """
        current, _ = self.manifest.current()
        live = {folder["path"] for folder in self.manifest.forget(keep, now)}
        return sum(self._vacuumed(root, current, live) for root in (self.path, self.counts_path))

    def _vacuumed(self, root: str, current: int, live: set[str]) -> int:
        storage = Storage(self.spark, root)
        removed = 0
        for version in storage.names():
            number = version.removeprefix("version=")
            # Later versions are not committed yet
            if not number.isdigit() or int(number) > current:
                continue
            found = [
                f"{version}/{view}/{day}"
                for view, days in self._subfolders(root, version).items()
                for day in days
            ]
            dead = [path for path in found if path not in live]
            for path in [version] if len(dead) == len(found) else dead:
                storage.remove(path)
            removed += len(dead)
        return removed
