"""Loading, computing, storing, publishing."""

from dataclasses import replace
from datetime import date, timedelta
from decimal import Decimal

import pytest
from conftest import day, long_values, put, rows_of
from pyspark.sql import functions as F

from tidemark.operators.integrity import commerce_checks
from tidemark.plans.compute import backfill, compute_features
from tidemark.plans.jobs import apply_definitions
from tidemark.plans.publish import (
    current_rows,
    materialize,
    parity_differences,
    published_wide,
    stale_entities,
)
from tidemark.plans.purchase_stats import FEATURES, VIEW
from tidemark.sources import schemas
from tidemark.sources.files import read_training_csv, write_training_csv
from tidemark.sources.online import asked_rows, read_entities, read_features
from tidemark.sources.registry import (
    ACTIVE,
    DEPRECATED,
    TESTING,
    FeatureDefinition,
    FeatureView,
    NotRegisteredError,
)

TWO_DAYS = timedelta(days=2)


def load(store, orders, users=((1, day(1)), (2, day(2)), (3, day(20)))):
    spark = store.spark
    rows = [(n, user, ts, Decimal(amount)) for n, (user, ts, amount) in enumerate(orders)]
    views = [(1, 1, 1, day(3, 5)), (2, 1, 1, day(4, 5)), (3, 2, 1, day(9))]
    return store.raw.replace_tables(
        {
            "users": spark.createDataFrame(list(users), schemas.USERS),
            "products": spark.createDataFrame([(1, "books", Decimal("2.50"))], schemas.PRODUCTS),
            "orders": spark.createDataFrame(rows, schemas.ORDERS),
            "product_views": spark.createDataFrame(views, schemas.PRODUCT_VIEWS),
            "order_items": spark.createDataFrame(
                [(n, 1, 1, row[3]) for n, row in enumerate(rows)], schemas.ORDER_ITEMS
            ),
        }
    )


ORDERS = [(1, day(3), "10"), (1, day(5), "20"), (2, day(4), "7.50")]


def test_second_load_replaces_the_first(store):
    counts = {"users": 3, "products": 1, "orders": 3, "product_views": 3, "order_items": 3}
    assert load(store, ORDERS) == counts
    assert load(store, ORDERS[:1]) == counts | {"orders": 1, "order_items": 1}
    raw = store.raw.read()
    assert raw.orders.count() == 1
    assert "order_date" in raw.orders.columns
    checks = commerce_checks(raw)
    assert checks.where("status <> 'ok'").count() == 0


def test_integrity_finds_what_is_broken(spark, store):
    load(store, ORDERS)
    raw = store.raw.read()
    broken = replace(
        raw,
        users=raw.users.unionByName(raw.users.where("user_id = 1")),
        orders=raw.orders.withColumn("user_id", F.when(F.col("order_id") > 0, F.col("user_id"))),
        order_items=raw.order_items.withColumns(
            {"quantity": F.lit(0), "product_id": F.lit(5).cast("bigint")}
        ),
    )
    alerts = commerce_checks(broken).where("status = 'alert'")
    assert {(name, metric): value for name, metric, value in rows_of(
        alerts, "name", "metric", "value")} == {
        ("users", "primary_key"): 1.0,
        ("orders", "not_null_user_id"): 1.0,
        ("order_items", "check_quantity"): 3.0,
        ("order_items", "foreign_key_product_id"): 3.0,
        ("orders", "item_totals"): 3.0,
    }


def test_compute_is_idempotent_and_picks_up_late_events(store):
    load(store, ORDERS)
    apply_definitions(store)
    first = day(25)
    assert compute_features(store, VIEW, day(6), now=first) == 8
    assert compute_features(store, VIEW, day(6), now=day(26)) == 0
    load(store, [*ORDERS, (2, day(5, 12), "2.50")])
    later = day(27)
    # Count, mean and recency of user 2 change; its view count and user 1 do not
    assert compute_features(store, VIEW, day(6), now=later) == 3
    stamps = store.values.read().groupBy("entity_id", "created_at").count()
    found = {(e, at.day): n for e, at, n in rows_of(stamps)}
    assert found == {(1, 25): 4, (2, 25): 1, (2, 27): 3}
    user_2 = store.values.snapshot(day(6), VIEW).where("entity_id = 2")
    assert dict(rows_of(user_2, "feature_name", "value"))["avg_order_value_30d"] == 5.0


def test_vanished_entities_stay(store):
    load(store, ORDERS)
    apply_definitions(store)
    compute_features(store, VIEW, day(6))
    load(store, ORDERS, users=[(1, day(1))])
    assert compute_features(store, VIEW, day(6)) == 0
    assert store.values.snapshot(day(6)).select("entity_id").distinct().count() == 2


def test_backfill_equals_single_days(store):
    load(store, ORDERS)
    apply_definitions(store)
    # Users 1 and 2 on the 6th and 7th
    assert backfill(store, VIEW, date(2026, 3, 6), date(2026, 3, 7)) == 16
    assert backfill(store, VIEW, date(2026, 3, 6), date(2026, 3, 7)) == 0
    assert compute_features(store, VIEW, day(7)) == 0
    assert backfill(store, VIEW, date(2026, 3, 6), date(2026, 3, 8)) == 8
    assert backfill(store, VIEW, date(2026, 3, 8), date(2026, 3, 6)) == 0


def test_compute_needs_a_valid_view(store):
    load(store, ORDERS)
    with pytest.raises(NotRegisteredError):
        compute_features(store, "typo", day(6))
    store.registry.apply(
        [FeatureView("empty", "user"),
         FeatureView("own", "user", source_sql="SELECT user_id AS entity_id, 1 AS a FROM users "
                                               "WHERE signup_ts < :as_of")],
        [FeatureDefinition("a", "own"), FeatureDefinition("old", "own", status=DEPRECATED)],
    )
    with pytest.raises(ValueError, match="no source SQL"):
        compute_features(store, "empty", day(6))
    assert compute_features(store, "own", day(6)) == 2
    # A view without a many-snapshot form is filled day by day
    assert backfill(store, "own", date(2026, 3, 6), date(2026, 3, 7)) == 2
    store.registry.register_feature(FeatureDefinition("b", "own", status=TESTING))
    with pytest.raises(ValueError, match="does not return: \\['b'\\]"):
        compute_features(store, "own", day(6))


def test_registry(store):
    view = FeatureView("v", "user", ttl=TWO_DAYS, owner="me")
    store.registry.apply(
        [view, FeatureView("w", "product")],
        [FeatureDefinition("b", "v", expected_max=9), FeatureDefinition("a", "v"),
         FeatureDefinition("old", "v", status=DEPRECATED), FeatureDefinition("c", "w")],
    )
    names = lambda **by: [f.feature_name for f in store.registry.list_features(**by)]
    assert store.registry.get_view("v") == view
    assert names() == ["a", "b", "c"]
    assert names(status=None, view_name="v") == ["a", "b", "old"]
    assert names(status=DEPRECATED) == ["old"]
    store.registry.register_view(FeatureView("v", "user"))
    assert store.registry.get_view("v") == FeatureView("v", "user")
    store.registry.register_feature(FeatureDefinition("b", "w", status=ACTIVE))
    assert store.registry.get_feature("b") == FeatureDefinition("b", "w")
    for unknown in (
        lambda: store.registry.get_view("x"),
        lambda: store.registry.get_feature("x"),
        lambda: store.registry.register_feature(FeatureDefinition("x", "x")),
        lambda: store.registry.ttls(["a", "x"]),
    ):
        with pytest.raises(NotRegisteredError):
            unknown()
    with pytest.raises(ValueError):
        FeatureDefinition("x", "v", dtype="text")


@pytest.fixture
def published(store):
    store.registry.apply(
        [FeatureView("v", "user", ttl=TWO_DAYS)],
        [FeatureDefinition("spend", "v"), FeatureDefinition("clicks", "v", status=TESTING),
         FeatureDefinition("old", "v", status=DEPRECATED)],
    )
    put(
        store,
        "v",
        [
            ("spend", 1, day(1), 10.0),
            ("spend", 1, day(2), 20.0),
            ("clicks", 1, day(2), None),
            ("old", 1, day(2), 1.0),
            ("spend", 2, day(4), 40.0),
            ("spend", 1, day(5), 999.0),
        ],
    )
    return store


def test_latest_rows(published):
    rows = {row["entity_id"]: row for row in current_rows(published, "v", day(3)).collect()}
    assert set(rows) == {1}
    assert rows[1]["values"] == {"spend": 20.0, "clicks": None}
    assert rows[1]["event_timestamp"].day == 2
    # The ttl is inclusive: the value of the 2nd is still there on the 4th
    at_4 = rows_of(current_rows(published, "v", day(4)), "entity_id")
    assert sorted(at_4) == [(1,), (2,)]
    with pytest.raises(NotRegisteredError):
        current_rows(published, "typo", day(3))


def test_publishing_only_moves_forward(published):
    assert published.online.until("v") is None
    assert materialize(published, "v", day(2)) == 1
    assert materialize(published, "v", day(2)) == 1
    before = published.online.read("v")
    assert rows_of(before.select(F.map_keys("values"))) == [(["spend"],)]
    assert materialize(published, "v", day(4, 6)) == 1
    assert published.online.until("v") == day(4, 6)
    assert rows_of(published.online.read("v"), "entity_id") == [(2,)]
    assert rows_of(stale_entities(before, published.online.read("v"))) == [(1,)]
    assert materialize(published, "v", day(2)) is None
    assert rows_of(published.online.read("v"), "entity_id") == [(2,)]
    assert materialize(published, "v", day(2), force=True) == 1
    assert published.online.until("v") == day(2)
    assert rows_of(published_wide(published, "v"), "entity_id", "spend", "clicks") == [
        (1, 20.0, None)
    ]
    assert parity_differences(published, "v").count() == 0


def test_parity_sees_differences(published):
    materialize(published, "v", day(2))
    put(published, "v", [("spend", 1, day(2), 21.0)])
    assert rows_of(parity_differences(published, "v")) == [(1, "spend", 20.0, 21.0)]


@pytest.mark.parametrize("hot_rows", [1, None])
def test_enrichment(published, hot_rows):
    materialize(published, "v", day(2))
    requests = published.spark.createDataFrame([(n, e) for n, e in enumerate([1, 9, 1, 1])],
                                               "n int, entity_id bigint")
    rows = published.online.read("v")
    found = read_entities(requests, rows, hot_rows).orderBy("n").collect()
    assert [row["found"] for row in found] == [True, False, True, True]
    assert found[0]["values"] == {"spend": 20.0}
    named = read_features(requests, rows, ["clicks", "spend"], hot_rows).orderBy("n")
    assert rows_of(named, "clicks", "spend") == [
        (None, 20.0), (None, None), (None, 20.0), (None, 20.0),
    ]


def test_training_csv(spark, tmp_path):
    rows = [(1, day(1), 1.0, None, 2.5, 0.0, 1), (2, day(1), 0.0, 3.25, None, 4.0, 0)]
    columns = ", ".join(f"{name} double" for name in FEATURES)
    frame = spark.createDataFrame(
        rows, f"entity_id bigint, event_timestamp timestamp, {columns}, label int"
    )
    write_training_csv(frame, str(tmp_path / "csv"))
    back = read_training_csv(spark, str(tmp_path / "csv"), FEATURES)
    assert sorted(rows_of(back)) == sorted(rows_of(frame))


def test_values_of_any_day_prune_partitions(store):
    put(store, "v", [("spend", 1, day(n), 1.0) for n in range(1, 6)])
    plan = store.values.until(day(4), "v", TWO_DAYS)._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "view_name" in filters and "snapshot_date" in filters
    assert long_values(store.spark, []).count() == 0


def test_a_few_requests_read_their_buckets_only(spark, store):
    put(store, "v", [("spend", n, day(1), float(n)) for n in range(200)])
    store.registry.apply([FeatureView("v", "user")], [FeatureDefinition("spend", "v")])
    assert materialize(store, "v", day(2)) == 200
    published = store.online.published("v")
    requests = spark.createDataFrame([(7, "a"), (7, "b"), (None, "c"), (900, "d")], "entity_id bigint, n string")
    rows = asked_rows(requests, published)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning(entity_id" not in plan.split("BroadcastExchange")[0]
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "bucket" in filters
    assert rows.count() == 1
    for most in (0, 1_000):
        found = read_entities(requests, published) if most else read_entities(
            requests, asked_rows(requests, published, 0)
        )
        assert sorted(rows_of(found, "n", "found")) == [
            ("a", True), ("b", True), ("c", False), ("d", False)
        ]
