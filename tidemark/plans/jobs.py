"""What runs every day and every week, as plain functions for any scheduler."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime

from tidemark.functions.snapshots import monthly_snapshots
from tidemark.plans.compute import compute_features
from tidemark.plans.definitions import FEATURES, VIEWS
from tidemark.plans.modeling import MODEL_FEATURES, TrainingResult, train_and_register
from tidemark.plans.monitoring import monitor_features, validate_snapshot
from tidemark.plans.publish import materialize
from tidemark.plans.retraining import retrain, retrain_reasons
from tidemark.plans.store import FeatureStore
from tidemark.plans.training import PURCHASE_NEXT_30D, Label, build_training_set
from tidemark.sources.files import write_training_csv


class InvalidSnapshotError(ValueError):
    """A snapshot breaks the thresholds of its features and must not be published."""


@dataclass(frozen=True)
class DailyRun:
    written: int
    published: int | None
    note: str | None


def apply_definitions(store: FeatureStore) -> None:
    store.registry.apply(VIEWS, FEATURES)


def run_daily(
    store: FeatureStore, view_name: str, as_of: datetime, now: datetime | None = None
) -> DailyRun:
    """Compute, validate and publish, and monitor whatever the outcome.

    Bad values are logged but not published. Monitoring comes last and stands apart: an error there
    is raised, but what was valid is published by then.
    """
    written = compute_features(store, view_name, as_of, now)
    try:
        found = validate_snapshot(store, view_name, as_of)
        if found:
            raise InvalidSnapshotError("; ".join(found))
        published = materialize(store, view_name, as_of)
    finally:
        _, note = monitor_features(store, view_name, as_of, now)
    return DailyRun(written, published, note)


def run_weekly(
    store: FeatureStore,
    as_of: datetime,
    start: date,
    label: Label = PURCHASE_NEXT_30D,
    now: datetime | None = None,
) -> tuple[list[str], TrainingResult | None]:
    """Retrain only if there is a reason to; returns the reasons and the result."""
    reasons = retrain_reasons(store, as_of, label, now)
    return reasons, retrain(store, as_of, start, label) if reasons else None


def export_training_set(store: FeatureStore, start: date, end: date, path: str) -> None:
    """Write the training set of every first of a month in a range as CSV."""
    names = [feature.feature_name for feature in FEATURES]
    training = build_training_set(store, monthly_snapshots(start, end), names)
    write_training_csv(training, path)


def train(store: FeatureStore, start: date, end: date, test_from: datetime) -> TrainingResult:
    """Train on monthly snapshots and make the new version the champion."""
    frame = build_training_set(store, monthly_snapshots(start, end), MODEL_FEATURES)
    return train_and_register(store, frame, test_from)
