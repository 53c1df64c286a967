"""The published store: the latest values of every entity, one row per entity and view."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.time import epoch_micros, from_epoch_micros
from tidemark.operators.hot import HOT_ROWS, lookup_join
from tidemark.operators.latest import without_nulls
from tidemark.sources import schemas
from tidemark.sources.tables import CommitLog, nullable

_MARKS = T.StructType(
    [T.StructField(name, T.LongType()) for name in ("until_micros", "entities", "buckets")]
)
# Entities of a bucket, roughly; a view has from 8 to 4,096 buckets.
BUCKET_ENTITIES = 200_000
FEWEST_BUCKETS, MOST_BUCKETS = 8, 4096
# Requested entities that are broadcast to the buckets they are in (about 16 bytes each).
BROADCAST_ENTITIES = 500_000


def bucket_of(entity: Column, n_buckets: int) -> Column:
    return F.pmod(F.xxhash64(entity), F.lit(n_buckets)).cast("int")


@dataclass(frozen=True)
class Published:
    """A published version: its rows with their `bucket`, and how many buckets there are."""

    rows: DataFrame
    n_buckets: int


class OnlineStore:
    """Each publication writes a full new version of a view and then switches to it.

    Readers see the old or the new version, never a mixture, and entities that are not in the new
    version are gone. Rows are partitioned by a bucket of their entity, so that a few requests read
    the buckets they are in and not the whole version; the number of buckets follows the size of
    the version before.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = f"{root}/online"

    def _log(self, view_name: str) -> CommitLog:
        return CommitLog(self.spark, f"{self.root}/marks/{view_name}", _MARKS)

    def write(self, view_name: str, rows: DataFrame, as_of: datetime) -> int:
        """Replace everything published for the view; returns the number of entities."""
        log = self._log(view_name)
        last = log.last()
        version, before = (last["version"] + 1, last["entities"]) if last else (1, 0)
        n_buckets = min(max(before // BUCKET_ENTITIES, FEWEST_BUCKETS), MOST_BUCKETS)
        bucketed = without_nulls(rows).select(
            "entity_id",
            "event_timestamp",
            "values",
            bucket_of(F.col("entity_id"), n_buckets).alias("bucket"),
        )
        bucketed.hint("rebalance", F.col("bucket")).write.mode("overwrite").option(
            "partitionOverwriteMode", "static"
        ).partitionBy("bucket").parquet(f"{self.root}/{view_name}/v={version}")
        # Counting a written table reads only the Parquet footers
        entities = self.read(view_name, version).count()
        log.commit(
            version, until_micros=epoch_micros(as_of), entities=entities, buckets=n_buckets
        )
        return entities

    def until(self, view_name: str) -> datetime | None:
        """The moment the view was last published as of, or None if never."""
        last = self._log(view_name).last()
        return None if last is None else from_epoch_micros(last["until_micros"])

    def read(self, view_name: str, version: int | None = None) -> DataFrame:
        """`entity_id, event_timestamp, values` as published last (or in an earlier version)."""
        if version is None:
            found = self.published(view_name)
            if found is None:
                return self.spark.createDataFrame([], nullable(schemas.ONLINE))
            return found.rows.drop("bucket")
        return self._rows(view_name, version).drop("bucket")

    def _rows(self, view_name: str, version: int) -> DataFrame:
        schema = nullable(schemas.ONLINE).add("bucket", T.IntegerType())
        return self.spark.read.schema(schema).parquet(f"{self.root}/{view_name}/v={version}")

    def published(self, view_name: str) -> Published | None:
        """The last version with its buckets, or None if the view was never published."""
        last = self._log(view_name).last()
        if last is None:
            return None
        return Published(self._rows(view_name, last["version"]), last["buckets"])


def asked_rows(requests: DataFrame, published: Published, most: int = BROADCAST_ENTITIES) -> DataFrame:
    """The published rows that requests may want: with up to `most` requested entities these
    alone, out of their buckets, by a broadcast that leaves the published side where it is.
    """
    wanted = requests.select("entity_id").dropna().distinct()
    bucket = bucket_of(F.col("entity_id"), published.n_buckets)
    counted = wanted.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n")).collect()
    if sum(row["n"] for row in counted) > most:
        return published.rows.drop("bucket")
    own = published.rows.where(F.col("bucket").isin([row["bucket"] for row in counted]))
    return own.drop("bucket").join(F.broadcast(wanted), "entity_id", "left_semi")


def read_entities(
    requests: DataFrame, published: DataFrame | Published, hot_rows: int | None = HOT_ROWS
) -> DataFrame:
    """Add everything published for each request's entity: `found, features_as_of, values`.

    An entity with nothing published is kept with `found` false and no values.
    """
    if isinstance(published, Published):
        published = asked_rows(requests, published)
    named = published.select(
        "entity_id", F.col("event_timestamp").alias("features_as_of"), "values"
    )
    joined = lookup_join(requests, named, ["entity_id"], hot_rows)
    return joined.withColumn("found", F.col("features_as_of").isNotNull())


def read_features(
    requests: DataFrame,
    published: DataFrame | Published,
    features: Sequence[str],
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Add one column per feature; null where the entity or the feature has no value."""
    joined = read_entities(requests, published, hot_rows)
    return joined.select(
        *requests.columns,
        "found",
        "features_as_of",
        *[F.try_element_at("values", F.lit(name)).alias(name) for name in features],
    )
