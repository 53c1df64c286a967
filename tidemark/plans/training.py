"""Training sets: labels joined with the features known at their moment."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import DataFrame

from tidemark.operators.labels import bought_within, require_final
from tidemark.plans.compute import sql_at
from tidemark.plans.historical import historical_features
from tidemark.plans.store import FeatureStore
from tidemark.session import cut
from tidemark.sources.adapters import Commerce


@dataclass(frozen=True)
class Label:
    """What a model learns, and how far it looks ahead.

    Purchases by default. Otherwise `frame` is a function of the raw tables and the snapshots that
    returns `entity_id, event_timestamp, label` for all of them, or `sql` does the same: over the
    table `snapshots` in one pass, or with the parameter `as_of` for each.
    """

    name: str
    horizon: timedelta
    sql: str | None = None
    frame: Callable[[Commerce, Sequence[datetime]], DataFrame] | None = None

    def rows(self, commerce: Commerce, snapshots: Sequence[datetime]) -> DataFrame:
        """`entity_id, event_timestamp, label`; raises while a label window is still open."""
        require_final(commerce.orders, snapshots, self.horizon)
        if self.frame is not None:
            found = self.frame(commerce, snapshots)
        elif self.sql is not None:
            found = sql_at(commerce, self.sql, snapshots)
        else:
            found = bought_within(commerce.users, commerce.orders, snapshots, self.horizon)
        return found.select("entity_id", "event_timestamp", "label")


PURCHASE_NEXT_30D = Label("purchase_next_30d", timedelta(days=30))


def build_training_set(
    store: FeatureStore,
    snapshots: Sequence[datetime],
    feature_names: Sequence[str],
    label: Label = PURCHASE_NEXT_30D,
) -> DataFrame:
    """One row per entity and snapshot: `entity_id, event_timestamp, <features>, label`.

    The label rides along as a request column, so labels and features need no join of their own.
    An entity has at most one request per snapshot and a few values per day, so there are no hot
    entities to look for.
    """
    labels = cut(label.rows(store.raw.read(), snapshots))
    training = historical_features(store, labels, feature_names, hot_rows=None)
    return training.select("entity_id", "event_timestamp", *feature_names, "label")
