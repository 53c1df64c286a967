"""Publish the latest values of a view."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.time import iso_text, moment
from tidemark.operators.latest import latest_rows, latest_values, without_nulls
from tidemark.operators.reshape import to_wide
from tidemark.plans.store import FeatureStore
from tidemark.sources.registry import FeatureView


def current_rows(store: FeatureStore, view_name: str, as_of: datetime) -> DataFrame:
    """The latest valid values per entity of a view, out of the store."""
    view = store.registry.get_view(view_name)
    features = [feature.feature_name for feature in store.registry.in_use(view_name)]
    return latest_rows(visible_values(store, view, as_of), as_of, view.ttl, features)


def visible_values(store: FeatureStore, view: FeatureView, as_of: datetime) -> DataFrame:
    """Values among which are the latest ones of a view: those within its ttl, or without one the
    state at the first of the month and the days since."""
    if view.ttl is not None:
        return store.values.until(moment(as_of), view.view_name, view.ttl)
    known = store.values.as_known(view.view_name, [moment(as_of).astimezone(UTC).date()])
    return known.where(F.col("event_timestamp") <= F.lit(as_of))


def materialize(
    store: FeatureStore, view_name: str, as_of: datetime, force: bool = False
) -> int | None:
    """Publish a view as of a moment; returns the number of entities.

    Publishing only moves forward: with a later moment already published, nothing is written and
    None is returned, unless `force` is set. Entities without a valid value disappear.
    """
    until = store.online.until(view_name)
    if until is not None and moment(as_of) < until and not force:
        return None
    return store.online.write(view_name, current_rows(store, view_name, as_of), as_of)


def stale_entities(published: DataFrame, current: DataFrame) -> DataFrame:
    """Published entities that have no valid value any more."""
    return published.select("entity_id").join(current.select("entity_id"), "entity_id", "left_anti")


def parity_differences(store: FeatureStore, view_name: str) -> DataFrame:
    """Where the published values differ from the latest stored ones at the published moment.

    `entity_id, feature_name, published, stored`; no rows means both agree. Both sides are stacked
    and grouped once, so an entity that only one side has is found, and what was published is not
    joined with the store. A stored null counts as nothing published.
    """
    until = store.online.until(view_name)
    if until is None:
        raise LookupError(f"view '{view_name}' was never published")
    features = [feature.feature_name for feature in store.registry.in_use(view_name)]
    view = store.registry.get_view(view_name)
    stored = latest_values(
        visible_values(store, view, until).where(F.col("feature_name").isin(features)),
        until,
        view.ttl,
    )
    published = store.online.read(view_name).select(
        "entity_id", F.explode("values").alias("feature_name", "published")
    )
    both = stored.select("entity_id", "feature_name", F.col("value").alias("stored")).unionByName(
        published, allowMissingColumns=True
    )
    sides = both.groupBy("entity_id", "feature_name").agg(
        F.max("published").alias("published"), F.max("stored").alias("stored")
    )
    return sides.where(~F.col("stored").eqNullSafe(F.col("published"))).select(
        "entity_id", "feature_name", "published", "stored"
    )


def published_wide(store: FeatureStore, view_name: str) -> DataFrame:
    """The published rows with one column per feature."""
    features = [feature.feature_name for feature in store.registry.in_use(view_name)]
    long = without_nulls(store.online.read(view_name)).select(
        "entity_id",
        "event_timestamp",
        F.explode_outer("values").alias("feature_name", "value"),
    )
    return to_wide(long, features, ["entity_id", "event_timestamp"])


def published_documents(store: FeatureStore, view_name: str) -> DataFrame:
    """The published rows as texts for other stores: `entity_id, features_as_of, document`.

    The moment is in ISO form, the document a JSON object of the features that have a value.
    """
    rows = without_nulls(store.online.read(view_name))
    return rows.select(
        "entity_id",
        iso_text(F.col("event_timestamp")).alias("features_as_of"),
        F.to_json("values").alias("document"),
    )
