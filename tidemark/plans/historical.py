"""Point-in-time correct features for request rows, read from the store."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.time import from_iso_text, moment
from tidemark.operators.asof import asof_join
from tidemark.operators.hot import HOT_ROWS
from tidemark.operators.near import DAY, days_back, near_requests, on_visible_days, request_days
from tidemark.plans.store import FeatureStore


def request_rows(spark: SparkSession, rows: Sequence[tuple[int, datetime]]) -> DataFrame:
    """A small list of (entity, moment) as requests; `row_id` keeps the order."""
    schema = T.StructType(
        [
            T.StructField("row_id", T.LongType()),
            T.StructField("entity_id", T.LongType()),
            T.StructField("event_timestamp", T.TimestampType()),
        ]
    )
    numbered = [(n, entity, moment(ts)) for n, (entity, ts) in enumerate(rows)]
    return spark.createDataFrame(numbered, schema)


def exploded_requests(lists: DataFrame) -> DataFrame:
    """Parallel arrays `entity_ids` and `timestamps` as requests, one per position.

    `row_id` is the position within the row's arrays, other columns are kept. Timestamps may be
    ISO texts.
    """
    others = [name for name in lists.columns if name not in ("entity_ids", "timestamps")]
    pairs = F.posexplode(F.arrays_zip("entity_ids", "timestamps")).alias("row_id", "pair")
    return lists.select(*others, pairs).select(
        *others,
        "row_id",
        F.col("pair.entity_ids").alias("entity_id"),
        from_iso_text(F.col("pair.timestamps")).alias("event_timestamp"),
    )


def features_at(
    requests: DataFrame,
    values: DataFrame,
    ttls: Mapping[str, timedelta | None],
    hot_rows: int | None = HOT_ROWS,
    asked: tuple[dict[date, int], int] | None = None,
) -> DataFrame:
    """The as-of join, on stored values cut down to what the requests can see.

    First to the days within reach of the requested days (partitions of the store), then, while
    they fit a broadcast, to the requested entities on those days. What is left is shuffled.
    `asked` is what `request_days` says of the requests, if it is known.
    """
    days, n_requests = asked or request_days(requests)
    visible = on_visible_days(values, days, ttls, "feature_name")
    by_ttl: dict[timedelta | None, list[str]] = {}
    for name, ttl in ttls.items():
        by_ttl.setdefault(ttl, []).append(name)
    near = [
        near_requests(visible.where(F.col("feature_name").isin(names)), requests, days, ttl)
        for ttl, names in by_ttl.items()
    ]
    if hot_rows is not None and days and n_requests + visible.count() <= hot_rows:
        # Counted from the footers of the files in reach. Fewer rows in all hold no hot entity.
        hot_rows = None
    return asof_join(requests, reduce(DataFrame.unionByName, near), ttls, hot_rows)


def historical_features(
    store: FeatureStore,
    requests: DataFrame,
    feature_names: Sequence[str],
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Each request row with the value every feature had at its `event_timestamp`.

    Keeps all columns and duplicates of the requests. Features may come from several views, each
    with its own ttl. Of a view whose values never expire, the state at the first of each requested
    month and the days since are read. Raises NotRegisteredError for a name that is not registered.
    """
    ttls = store.registry.ttls(feature_names)
    definitions = store.registry.definitions().where(F.col("feature_name").isin(list(ttls)))
    view_of = {row["feature_name"]: row["view_name"] for row in definitions.collect()}
    asked = request_days(requests)
    days = asked[0]
    values = []
    for view, ttl in {view_of[name]: ttl for name, ttl in ttls.items()}.items():
        if ttl is None:
            values.append(store.values.as_known(view, days))
        else:
            first = min(days, default=date.min)
            # Whole days, as a validity can reach into a day before
            since = first - min(days_back(ttl) * DAY, first - date.min)
            until = max(days, default=date.min)
            values.append(store.values.read(view, since, until).where(F.col("view_name") == view))
    return features_at(requests, reduce(DataFrame.unionByName, values), ttls, hot_rows, asked)
