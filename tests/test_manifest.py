"""The value store: live folders, states of values that never expire, and removal."""

import random
from datetime import UTC, date, datetime, timedelta

import pytest
from conftest import long_values, put, rows_of
from pyspark.sql import functions as F

from tidemark.operators.drift import reference_distribution
from tidemark.plans.historical import historical_features, request_rows
from tidemark.plans.monitoring import stored_reference
from tidemark.plans.publish import current_rows
from tidemark.sources.manifest import Manifest, WriteConflictError
from tidemark.sources.registry import FeatureDefinition, FeatureView


def at(month, day, hour=0, year=2026):
    return datetime(year, month, day, hour, tzinfo=UTC)


def days_read(frame):
    return {file.split("snapshot_date=")[1][:10] for file in frame.inputFiles()}


def test_a_thousand_commits(store):
    put(store, "a", [("spend", 1, at(3, n), float(n)) for n in range(1, 6)])
    plan = lambda: store.values.read()._jdf.queryExecution().optimizedPlan().toString()
    version, folders = store.values.manifest.current()
    before = plan()
    for number in range(version + 1, version + 1001):
        store.values.manifest.commit(number, folders)
    assert put(store, "a", [("spend", 1, at(3, 2), 20.0)]) == 1
    assert put(store, "a", [("spend", 1, at(3, 2), 21.0)]) == 1
    found = sorted(rows_of(store.values.read(), "event_timestamp", "value"))
    assert [value for _, value in found] == [1.0, 21.0, 3.0, 4.0, 5.0]
    assert len(plan()) < 2 * len(before)
    assert len(store.values.read().inputFiles()) == 5


def test_vacuum_leaves_what_a_reader_may_still_need(store):
    put(store, "a b/c", [("spend", 1, at(3, 1), 1.0), ("spend", 1, at(3, 2), 2.0)])
    reader = store.values.read()
    put(store, "a b/c", [("spend", 1, at(3, 1), 3.0)])
    assert store.values.vacuum(timedelta(hours=1)) == 0
    assert sorted(rows_of(reader, "value")) == [(1.0,), (2.0,)]
    assert store.values.vacuum(timedelta(0), datetime.now(UTC) + timedelta(seconds=5)) == 1
    assert sorted(rows_of(store.values.read("a b/c"), "value")) == [(2.0,), (3.0,)]
    assert put(store, "a b/c", [("spend", 1, at(3, 1), 3.0)]) == 0
    assert store.values.vacuum(timedelta(0), datetime.now(UTC) + timedelta(seconds=5)) == 0


def test_of_two_writers_one_wins(spark, tmp_path):
    first, second = (Manifest(spark, str(tmp_path / "m")) for _ in range(2))
    version, _ = first.current()
    first.commit(version + 1, [{"n": 1}])
    with pytest.raises(WriteConflictError):
        second.commit(version + 1, [{"n": 2}])
    assert second.current() == (1, [{"n": 1}])


def known(values, moments):
    """The last value of every feature and entity at each moment."""
    found = {}
    for entity, moment in moments:
        for feature in ("color", "size"):
            seen = [(ts, v) for f, e, ts, v in values if (f, e) == (feature, entity) and ts <= moment]
            found[entity, moment, feature] = max(seen, key=lambda x: x[0])[1] if seen else None
    return found


@pytest.fixture
def lasting(store):
    store.registry.apply(
        [FeatureView("lasting", "user"), FeatureView("short", "user", ttl=timedelta(days=2))],
        [FeatureDefinition(name, "lasting") for name in ("color", "size")]
        + [FeatureDefinition("spend", "short")],
    )
    return store


def some_values(seed):
    rng = random.Random(seed)
    return {
        (rng.choice(["color", "size"]), rng.randrange(6), at(rng.randrange(1, 8), rng.randrange(1, 28))):
        rng.choice([None, 1.0, 2.0, 3.0])
        for _ in range(150)
    }


def check(store, values):
    rng = random.Random(4)
    asked = [(rng.randrange(7), at(rng.randrange(1, 10), rng.randrange(1, 28), 7)) for _ in range(60)]
    wide = historical_features(store, request_rows(store.spark, asked), ["size", "color", "spend"])
    expected = known([(*key, value) for key, value in values.items()], asked)
    for (entity, moment), row in zip(asked, wide.orderBy("row_id").collect(), strict=True):
        assert row["color"] == expected[entity, moment, "color"]
        assert row["size"] == expected[entity, moment, "size"]


def test_states_answer_for_the_days_before_them(lasting):
    values = some_values(1)
    put(lasting, "lasting", [(*key, value) for key, value in values.items()])
    put(lasting, "short", [("spend", 1, at(3, 1), 1.0)])
    check(lasting, values)
    assert lasting.values.advance_states("lasting", date(2026, 5, 20)) == 4
    assert lasting.values.advance_states("lasting", date(2026, 5, 31)) == 0
    check(lasting, values)
    # The months since then build on the last state
    assert lasting.values.advance_states("lasting", date(2026, 8, 1)) == 3
    check(lasting, values)
    for month, state in ((6, 6), (9, 8)):
        read = days_read(lasting.values.as_known("lasting", [date(2026, month, 20)]))
        assert min(read) == f"2026-{state:02}-01" and max(read) <= f"2026-{month:02}-20"
        assert len(read) <= 31


def test_a_late_value_ends_the_states_after_it(lasting):
    values = some_values(2)
    put(lasting, "lasting", [(*key, value) for key, value in values.items()])
    lasting.values.advance_states("lasting", date(2026, 8, 1))
    late = {("color", 3, at(4, 2)): 9.0, ("size", 5, at(4, 30)): None}
    put(lasting, "lasting", [(*key, value) for key, value in late.items()])
    left = [folder["day"] for folder in lasting.values.folders("lasting", kind="state")]
    assert max(left) == "2026-04-01"
    values |= late
    check(lasting, values)
    assert lasting.values.advance_states("lasting", date(2026, 8, 1)) == 4
    check(lasting, values)
    # The same values again change nothing, so all states stay
    put(lasting, "lasting", [(*key, value) for key, value in late.items()])
    assert lasting.values.advance_states("lasting", date(2026, 8, 1)) == 0


def test_published_rows_come_from_a_state(lasting):
    values = some_values(3)
    put(lasting, "lasting", [(*key, value) for key, value in values.items()])
    before = sorted(map(str, rows_of(current_rows(lasting, "lasting", at(7, 15)))))
    lasting.values.advance_states("lasting", date(2026, 8, 1))
    assert sorted(map(str, rows_of(current_rows(lasting, "lasting", at(7, 15))))) == before
    assert before


def test_a_very_long_ttl(store):
    store.registry.apply(
        [FeatureView("v", "user", ttl=timedelta(days=999_999_999))], [FeatureDefinition("f", "v")]
    )
    put(store, "v", [("f", 1, at(1, 1), 4.0)])
    found = historical_features(store, request_rows(store.spark, [(1, at(9, 9)), (2, at(9, 9))]), ["f"])
    assert rows_of(found.orderBy("row_id"), "f") == [(4.0,), (None,)]
    assert long_values(store.spark, []).where(F.lit(True)).count() == 0


def test_counts_of_days_add_up(store):
    """A day is counted once, and again after it changed; a reference reads the counts only."""
    values = some_values(6)
    nan = {("size", 9, at(3, 3)): float("nan"), ("size", 8, at(3, 3)): None}
    put(store, "v", [(*key, value) for key, value in (values | nan).items()])
    put(store, "other", [("color", 1, at(3, 3), 77.0)])

    def reference(since, until):
        return sorted(map(str, stored_reference(store, "v", since, until).collect()))

    def plain(since, until):
        rows = store.values.read("v", since, until)
        return sorted(map(str, reference_distribution(rows).collect()))

    march, may = date(2026, 3, 1), date(2026, 5, 31)
    days = len(store.values.folders("v", march, may))
    assert store.values.count_days("v", march, may) == days
    assert store.values.count_days("v", march, may) == 0
    assert all("feature_value_counts" in f for f in store.values.counts("v", march, may).inputFiles())
    assert reference(march, may) == plain(march, may)
    put(store, "v", [("size", 9, at(3, 3), 4.0)])
    assert store.values.count_days("v", march, may) == 1
    assert reference(march, may) == plain(march, may)
    assert reference(march, date(2026, 7, 31)) == plain(march, date(2026, 7, 31))
    before = plain(march, may)
    store.values.vacuum(timedelta(0), datetime.now(UTC) + timedelta(seconds=5))
    assert reference(march, may) == before
