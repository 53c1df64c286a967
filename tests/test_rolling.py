"""Totals carried on from day to day, and late events, against a full computation."""

import random
from datetime import date, timedelta

import pytest
from conftest import day, rows_of

from tidemark.plans.compute import backfill
from tidemark.plans.jobs import apply_definitions
from tidemark.plans.purchase_stats import VIEW
from tidemark.plans.rolling import RollingStats, apply_late, late_commerce, late_pairs
from tidemark.plans.store import FeatureStore
from tidemark.session import cut
from tidemark.sources import schemas

START, END = date(2026, 4, 5), date(2026, 4, 7)


def events(seed, n=160, users=8, first=1, days=60):
    """Orders and views over two months; user 1 has a third of them."""
    rng = random.Random(seed)
    orders, views = [], []
    for number in range(n):
        user = 1 if rng.random() < 0.34 else rng.randrange(2, users)
        moment = day(1, month=3) + timedelta(days=rng.randrange(first, days), hours=rng.randrange(24))
        orders.append((seed * 1000 + number, user, moment, rng.randrange(1, 9999) / 100))
        user = rng.randrange(1, users + 2)
        views.append((seed * 1000 + number, user, 5, moment + timedelta(hours=rng.randrange(40))))
    return orders, views


def frames(spark, orders, views):
    from decimal import Decimal

    orders = [(*row[:3], Decimal(str(row[3]))) for row in orders]
    return {
        "orders": spark.createDataFrame(orders, schemas.ORDERS),
        "product_views": spark.createDataFrame(views, schemas.PRODUCT_VIEWS),
    }


def users(spark):
    rows = [(n, day(1, month=3) + timedelta(days=4 * n)) for n in range(1, 12)]
    return {"users": spark.createDataFrame(rows, schemas.USERS)}


def stored(store, since=START, until=END):
    rows = rows_of(
        store.values.read(VIEW, since, until), "feature_name", "entity_id", "event_timestamp", "value"
    )
    return {row[:3]: None if row[3] is None else round(row[3], 9) for row in rows}


@pytest.fixture
def full(spark, tmp_path):
    """The same events loaded at once and computed for all days."""

    def build(orders, views, since=START, until=END):
        store = FeatureStore(spark, str(tmp_path / "full"))
        store.raw.replace_tables({**users(spark), **frames(spark, orders, views)})
        apply_definitions(store)
        backfill(store, VIEW, since, until)
        return stored(store, since, until)

    return build


def test_each_day_equals_a_full_computation(store, full):
    orders, views = events(1)
    store.raw.replace_tables({**users(store.spark), **frames(store.spark, orders, views)})
    apply_definitions(store)
    rolling = RollingStats(store)
    with pytest.raises(LookupError):
        rolling.advance()
    rolling.start(START)
    assert rolling.as_of() == START
    while rolling.as_of() < END:
        assert rolling.advance() > 0
    assert stored(store) == full(orders, views)


def test_a_day_reads_one_day_of_events(store, monkeypatch):
    from tidemark.plans import rolling as module

    orders, views = events(2)
    store.raw.replace_tables({**users(store.spark), **frames(store.spark, orders, views)})
    apply_definitions(store)
    rolling = RollingStats(store)
    rolling.start(START)
    read, plain = [], module.activity

    def seen(commerce, since, until):
        found = plain(commerce, since, until)
        read.append(found._jdf.queryExecution().executedPlan().toString())
        read.append({f.split("_date=")[1][:10] for f in found.inputFiles() if "_date=" in f})
        return found

    monkeypatch.setattr(module, "activity", seen)
    rolling.advance()
    [plan, _] = read
    assert plan.count("PartitionFilters: [isnotnull") == 2
    for column in ("order_date", "view_date"):
        assert f"{column}#" in plan and f">= {START}" in plan and f"<= {START}" in plan
    # Days that no window holds any more are not listed
    kept = {f["day"] for f in rolling.manifest.current()[1] if f["kind"] == "activity"}
    assert len(kept) == 30 and min(kept) == str(START - timedelta(days=29))


def test_late_events_in_old_days(store, full):
    orders, views = events(3)
    late_orders, late_views = events(4, n=6, days=37)
    store.raw.replace_tables({**users(store.spark), **frames(store.spark, orders, views)})
    apply_definitions(store)
    since, until = date(2026, 3, 20), date(2026, 4, 12)
    backfill(store, VIEW, since, until)
    load = store.raw.add_rows(frames(store.spark, late_orders, late_views))
    assert store.raw.read().orders.count() == len(orders) + len(late_orders)

    computed = [since + timedelta(days=n) for n in range((until - since).days + 1)]
    pairs = cut(late_pairs(store, load, computed))
    read = late_commerce(store, pairs)
    of_late = {row[1] for row in late_orders} | {row[1] for row in late_views}
    assert {row.user_id for row in read.orders.collect()} <= of_late
    first = min(min(row[2] for row in late_orders).date(), since) - timedelta(days=30)
    in_reach = [row for row in orders + late_orders if row[1] in of_late and row[2].date() >= first]
    assert read.orders.count() <= len(in_reach)

    found = apply_late(store, load)
    assert found.pairs == pairs.count() < 2 * len(computed) * len(of_late)
    assert found.written > 0
    expected = full(orders + late_orders, views + late_views, since, until)
    assert stored(store, since, until) == expected
    assert apply_late(store, load).written == 0


def test_a_late_order_long_before_the_first_computed_day(store, full):
    views = [(1, 2, 5, day(2, month=3))]
    orders = [(1, 1, day(2, month=3), 5.0)]
    store.raw.replace_tables({**users(store.spark), **frames(store.spark, orders, views)})
    apply_definitions(store)
    backfill(store, VIEW, date(2026, 5, 10), date(2026, 5, 11))
    late = [(2, 1, day(20, month=3), 7.0)]
    load = store.raw.add_rows({"orders": frames(store.spark, late, views)["orders"]})
    assert apply_late(store, load).written == 2
    assert stored(store, date(2026, 5, 10), date(2026, 5, 11)) == full(
        orders + late, views, date(2026, 5, 10), date(2026, 5, 11)
    )


def test_days_go_on_after_late_events(store, full):
    orders, views = events(5)
    late_orders, late_views = events(6, n=20, days=38)
    store.raw.replace_tables({**users(store.spark), **frames(store.spark, orders, views)})
    apply_definitions(store)
    rolling = RollingStats(store)
    rolling.start(START)
    rolling.advance()
    load = store.raw.add_rows(frames(store.spark, late_orders, late_views))
    apply_late(store, load)
    rolling.absorb(load)
    while rolling.as_of() < END:
        rolling.advance()
    assert stored(store) == full(orders + late_orders, views + late_views)


def test_loads_are_read_apart(store):
    orders, views = events(7, n=5)
    later_orders, _ = events(8, n=3)
    store.raw.replace_tables({**users(store.spark), **frames(store.spark, orders, views)})
    load = store.raw.add_rows({"orders": frames(store.spark, later_orders, views)["orders"]})
    added = store.raw.added(load)
    assert set(added) == {"orders"} and added["orders"].count() == 3
    assert store.raw.read().orders.count() == 8 and store.raw.read().product_views.count() == 5
    store.raw.replace_tables({**users(store.spark), **frames(store.spark, orders, views)})
    assert store.raw.read().orders.count() == 5
    with pytest.raises(LookupError):
        store.raw.added(99)
