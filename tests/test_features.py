"""The feature view, labels and snapshot grids."""

import random
from datetime import UTC, date, datetime, timedelta
from decimal import Decimal

import pytest
from conftest import day, rows_of
from pyspark.sql import functions as F

from tidemark.functions.snapshots import daily_snapshots, monthly_snapshots
from tidemark.functions.time import from_iso_text, iso_text
from tidemark.functions.values import general, percent
from tidemark.operators.labels import bought_within, require_final
from tidemark.operators.reshape import check_columns, to_long, to_wide
from tidemark.plans.compute import sql_at
from tidemark.plans.purchase_stats import FEATURES, SQL, purchase_stats, purchase_stats_at
from tidemark.session import prepare
from tidemark.sources import schemas
from tidemark.sources.adapters import Commerce

AS_OF = day(31)
HORIZON = timedelta(days=30)


def commerce(spark, users, orders=(), views=()):
    """users (id, signup), orders (user, moment, amount), views (user, moment)."""
    orders = [(n, user, ts, Decimal(amount)) for n, (user, ts, amount) in enumerate(orders)]
    views = [(n, user, 1, ts) for n, (user, ts) in enumerate(views)]
    return Commerce(
        spark.createDataFrame(list(users), schemas.USERS),
        spark.createDataFrame(orders, schemas.ORDERS),
        spark.createDataFrame(views, schemas.PRODUCT_VIEWS),
    )


def random_commerce(spark, n_users=12):
    rng = random.Random(3)
    moment = lambda: day(1) + timedelta(minutes=rng.randrange(60 * 24 * 60))
    users = [(n, moment()) for n in range(n_users)]
    # User 0 has a third of all events
    owner = lambda: 0 if rng.random() < 0.33 else rng.randrange(n_users)
    orders = [(owner(), moment(), f"{rng.randrange(1, 9999) / 100}") for _ in range(150)]
    views = [(owner(), moment()) for _ in range(300)]
    return commerce(spark, users, orders, views)


def test_windows_are_half_open(spark):
    raw = commerce(
        spark,
        [(1, day(1, month=1))],
        [
            (1, AS_OF, "99"),
            (1, AS_OF - timedelta(days=30), "10"),
            (1, AS_OF - timedelta(days=30, microseconds=1), "50"),
        ],
        [(1, AS_OF), (1, AS_OF - timedelta(days=7)), (1, AS_OF - timedelta(days=8))],
    )
    assert rows_of(purchase_stats(raw, AS_OF)) == [(1, 1, 10.0, 30.0, 1)]


def test_defaults_without_events(spark):
    raw = commerce(
        spark,
        [(1, day(1)), (2, day(1)), (3, AS_OF)],
        [(2, AS_OF - timedelta(days=45), "5")],
    )
    found = {row[0]: row[1:] for row in rows_of(purchase_stats(raw, AS_OF))}
    # User 3 signs up at the moment itself; user 2's last order is older than the window
    assert found == {1: (0, None, None, 0), 2: (0, None, 45.0, 0)}


def test_mean_is_not_rounded_to_cents(spark):
    raw = commerce(spark, [(1, day(1))], [(1, day(20), a) for a in ("1.00", "1.00", "1.01")])
    assert rows_of(purchase_stats(raw, AS_OF), "avg_order_value_30d") == [(3.01 / 3,)]


def test_sql_view_agrees(spark):
    raw = random_commerce(spark)
    for as_of in (day(20), day(20, 13)):
        by_sql = sql_at(raw, SQL, [as_of]).drop("event_timestamp")
        by_frame = purchase_stats(raw, as_of)
        assert by_sql.columns == by_frame.columns
        assert sorted(rows_of(by_sql)) == sorted(rows_of(by_frame))


def test_one_pass_equals_day_by_day(spark):
    raw = random_commerce(spark)
    snapshots = daily_snapshots(date(2026, 3, 3), date(2026, 4, 20))
    many = purchase_stats_at(raw, snapshots)
    for as_of in snapshots[::8]:
        one = sorted(rows_of(purchase_stats(raw, as_of)))
        at = many.where(F.col("event_timestamp") == F.lit(as_of)).drop("event_timestamp")
        assert sorted(rows_of(at)) == one
    counts = many.groupBy("event_timestamp").count().count()
    assert counts <= len(snapshots)


def test_moments_must_be_clear(spark):
    raw = commerce(spark, [(1, day(1))])
    with pytest.raises(ValueError, match="timezone-aware"):
        purchase_stats(raw, datetime(2026, 3, 1))
    with pytest.raises(ValueError, match="midnight"):
        purchase_stats_at(raw, [day(3, 5)])


def test_timestamps_as_text(spark):
    """Out and in again; a day or a moment without an offset is in UTC."""
    frame = spark.createDataFrame([(day(5, 7),)], "ts timestamp").select(iso_text(F.col("ts")).alias("t"))
    assert rows_of(frame) == [("2026-03-05T07:00:00+00:00",)]
    texts = frame.unionByName(
        spark.createDataFrame([("2026-03-05T09:00:00+02:00",), ("2026-03-05 07:00:00",)], "t string")
    )
    assert texts.where(from_iso_text(F.col("t")) != F.lit(day(5, 7))).count() == 0
    assert rows_of(spark.sql("SELECT '2026-03-01' AS t").where(from_iso_text(F.col("t")) == F.lit(day(1))))


def test_ties_in_messages(spark):
    frame = spark.createDataFrame([(0.0015, 1000005.0), (0.0025, 1000015.0)], "a double, b double")
    assert rows_of(frame.select(percent(F.col("a")), general(F.col("b")))) == [
        ("0.2%", "1.00001e+06"), ("0.2%", "1.00002e+06"),
    ]


def test_shuffle_partitions_follow_the_size(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    prepare(spark, 1024**2)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    prepare(spark, 100 * 1024**4)
    assert spark.conf.get("spark.sql.shuffle.partitions") == str(100 * 1024**4 // 256 // 1024**2)
    spark.conf.set("spark.sql.shuffle.partitions", before)


def test_monthly_grid_crosses_the_year():
    firsts = monthly_snapshots(date(2026, 11, 15), date(2027, 2, 1))
    assert [(d.year, d.month, d.day) for d in firsts] == [
        (2026, 12, 1), (2027, 1, 1), (2027, 2, 1),
    ]
    assert firsts[0].tzinfo == UTC
    assert monthly_snapshots(date(2026, 3, 1), date(2026, 3, 1)) == [day(1)]
    assert monthly_snapshots(date(2026, 3, 2), date(2026, 3, 31)) == []


def test_label_window_and_boundary(spark):
    """An order exactly at the snapshot is label, never feature."""
    raw = commerce(
        spark,
        [(1, day(1)), (2, day(1)), (3, day(1)), (4, AS_OF)],
        [(1, AS_OF, "5"), (2, AS_OF + HORIZON, "5"), (4, AS_OF + timedelta(days=1), "5")],
    )
    labels = bought_within(raw.users, raw.orders, [AS_OF], HORIZON)
    assert sorted(rows_of(labels, "entity_id", "label")) == [(1, 1), (2, 0), (3, 0)]
    assert rows_of(purchase_stats(raw, AS_OF).where("entity_id = 1"), "order_count_30d") == [(0,)]


def test_labels_of_many_snapshots(spark):
    raw = random_commerce(spark)
    snapshots = [day(5), day(12), day(31)]
    orders = rows_of(raw.orders, "user_id", "order_ts")
    users = rows_of(raw.users)
    expected = set()
    for at in snapshots:
        for user, signup in users:
            if signup < at.replace(tzinfo=None):
                bought = any(
                    owner == user and at.replace(tzinfo=None) <= ts < (at + HORIZON).replace(
                        tzinfo=None)
                    for owner, ts in orders
                )
                expected.add((user, at.replace(tzinfo=None), int(bought)))
    found = bought_within(raw.users, raw.orders, snapshots, HORIZON)
    assert set(rows_of(found, "entity_id", "event_timestamp", "label")) == expected


def test_open_label_windows_are_rejected(spark):
    raw = commerce(spark, [(1, day(1))], [(1, day(31), "1")])
    require_final(raw.orders, [day(1)], HORIZON)
    with pytest.raises(ValueError, match="2026-03-02 are not final"):
        require_final(raw.orders, [day(1), day(2)], HORIZON)
    with pytest.raises(ValueError, match="not final"):
        require_final(raw.orders.where("false"), [day(1)], HORIZON)


def test_long_and_wide(spark):
    wide = spark.createDataFrame([(1, 2, None, 3.5, 4)], f"entity_id bigint, {FEATURES[0]} bigint, "
                                 f"{FEATURES[1]} double, {FEATURES[2]} double, {FEATURES[3]} int")
    long = to_long(wide, FEATURES, ["entity_id"])
    assert sorted(rows_of(long, "feature_name", "value")) == sorted(
        zip(FEATURES, [2.0, None, 3.5, 4.0], strict=True)
    )
    assert rows_of(to_wide(long, FEATURES[::-1], ["entity_id"])) == [(1, 4.0, 3.5, None, 2.0)]
    with pytest.raises(ValueError, match="does not return: \\['entity_id', 'other'\\]"):
        check_columns(wide.drop("entity_id"), [*FEATURES, "other"], "v")


def test_labels_of_more_snapshots_than_bits_of_a_number(spark):
    """Users who signed up twice or are unknown, 150 snapshots given in any order."""
    rng = random.Random(9)
    moment = lambda: day(1) + timedelta(hours=rng.randrange(24 * 200))
    users = [(n, moment()) for n in range(6)] + [(0, moment())]
    orders = [(rng.randrange(9), moment(), "1.00") for _ in range(60)]
    snapshots = [day(1) + timedelta(days=n) for n in range(150)]
    rng.shuffle(snapshots)
    raw = commerce(spark, users, orders)
    horizon = timedelta(days=3)
    expected = sorted(
        (user, at, int(any(u == user and at <= ts < at + horizon for u, ts, _ in orders)))
        for user in range(6)
        for at in snapshots
        if any(u == user and ts < at for u, ts in users)
    )
    found = bought_within(raw.users, raw.orders, [*snapshots, snapshots[0]], horizon)
    columns = ["entity_id", F.date_format("event_timestamp", "yyyy-MM-dd").alias("at"), "label"]
    assert sorted(rows_of(found, *columns)) == [(u, f"{at:%Y-%m-%d}", b) for u, at, b in expected]


@pytest.mark.parametrize("make", ["labels", "features"])
def test_users_become_rows_per_snapshot_after_the_shuffle(spark, make):
    raw = random_commerce(spark)
    snapshots = daily_snapshots(date(2026, 3, 2), date(2026, 3, 20))
    if make == "labels":
        found = bought_within(raw.users, raw.orders, snapshots, HORIZON)
    else:
        found = purchase_stats_at(raw, snapshots)
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString()
    # The plan is printed from its end, so what comes first in it is done last
    final = plan.partition("Initial Plan")[0]
    assert final.index("Generate") < final.index("Exchange")
