"""Checks of what is stored, logged and summed up."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.values import ALERT
from tidemark.operators.drift import counted_distribution, drift_checks
from tidemark.operators.freshness import freshness_checks
from tidemark.operators.quality import problems, quality_checks
from tidemark.operators.status import current_status
from tidemark.plans.modeling import MODEL_NAME
from tidemark.plans.store import FeatureStore
from tidemark.session import cut
from tidemark.sources import schemas
from tidemark.sources.registry import definitions_frame


def snapshot_quality(store: FeatureStore, view_name: str, as_of: datetime) -> DataFrame:
    """The quality checks of a view's snapshot; raises for an unknown view."""
    store.registry.get_view(view_name)
    features = store.registry.in_use(view_name)
    if not features:
        empty = (view_name, "feature_count", 0.0, ALERT, "the view has no features")
        return store.spark.createDataFrame([empty], schemas.CHECKS)
    return quality_checks(
        definitions_frame(store.spark, features), store.values.snapshot(as_of, view_name), as_of
    )


def validate_snapshot(store: FeatureStore, view_name: str, as_of: datetime) -> list[str]:
    """What is wrong with a snapshot, as text; empty when nothing is."""
    found = problems(snapshot_quality(store, view_name, as_of))
    return sorted(row["problem"] for row in found.collect())


def stored_reference(
    store: FeatureStore, view_name: str, since: date, until: date, bins: int = 10
) -> DataFrame:
    """A drift reference of all values of some days, out of the stored counts of these days."""
    return counted_distribution(cut(store.values.counts(view_name, since, until)), bins)


def snapshot_drift(store: FeatureStore, reference: DataFrame, as_of: datetime) -> DataFrame:
    """The drift checks of a snapshot against a stored reference."""
    return drift_checks(reference, store.values.snapshot(as_of), as_of)


def freshness(store: FeatureStore, as_of: datetime) -> DataFrame:
    """The freshness checks of every active feature.

    Fresh values lie in the last days, so those partitions are read first; the whole history is
    only searched for features without a value there.
    """
    active = store.registry.list_features()
    hours = max((feature.freshness_hours for feature in active), default=0)
    recent = store.values.until(as_of, ttl=timedelta(hours=hours, days=1))
    found = {row[0] for row in recent.select("feature_name").distinct().collect()}
    missing = [f.feature_name for f in active if f.feature_name not in found]
    older = store.values.until(as_of).where(F.col("feature_name").isin(missing))
    values = recent.unionByName(older) if missing else recent
    return freshness_checks(definitions_frame(store.spark, active), values, as_of)


def monitor_features(
    store: FeatureStore, view_name: str, as_of: datetime, now: datetime | None = None
) -> tuple[DataFrame, str | None]:
    """Check a snapshot's quality and its drift from the champion's training data; log both.

    Without a champion or its reference only quality is checked, and the note says why.
    """
    checks, note = snapshot_quality(store, view_name, as_of), None
    champion = store.models.champion(MODEL_NAME)
    if champion is None:
        note = "drift not checked: there is no champion model yet"
    elif champion.reference is None:
        note = "drift not checked: the champion was trained without a drift reference"
    else:
        checks = checks.unionByName(snapshot_drift(store, champion.reference, as_of))
    checks = cut(checks)
    store.monitor.log("feature", as_of, checks, now)
    return checks, note


def monitor_status(store: FeatureStore, as_of: datetime) -> DataFrame:
    """One row: the overall status, and per feature and model its status and checks."""
    return current_status(store.monitor.read(), freshness(store, as_of), as_of)
