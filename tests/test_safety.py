"""What must not get lost, slip through or go unseen."""

from datetime import date, timedelta

import pytest
from conftest import day, long_values, put, rows_of
from pyspark.sql import functions as F
from test_models import JUNE, MAY, model_frame
from test_store import ORDERS, load

from tidemark.operators.asof import asof_join
from tidemark.operators.labels import bought_within
from tidemark.plans import jobs
from tidemark.plans.compute import (
    FrameView,
    backfill,
    compute_features,
    register_frame_view,
    sql_at,
    sql_parts,
    with_moment,
)
from tidemark.plans.jobs import apply_definitions, run_daily
from tidemark.plans.modeling import MODEL_NAME, compare_models, fit_logistic, temporal_split
from tidemark.plans.modeling import train_and_register
from tidemark.plans.publish import materialize, parity_differences
from tidemark.plans.purchase_stats import VIEW
from tidemark.plans.training import Label, build_training_set
from tidemark.session import cut, discard
from tidemark.sources.registry import FeatureDefinition, FeatureView


def stored(store, view=None):
    rows = rows_of(store.values.read(view), "feature_name", "entity_id", "event_timestamp", "value")
    return sorted((name, entity, at.day, value) for name, entity, at, value in rows)


def test_an_upsert_keeps_what_it_does_not_bring(store):
    put(store, "a", [("spend", 1, day(1), 1.0), ("spend", 2, day(1), 2.0), ("spend", 1, day(2), 3.0)])
    put(store, "b", [("clicks", 1, day(1), 4.0)])
    assert put(store, "a", [("spend", 3, day(1), 5.0)]) == 1
    assert put(store, "a", [("spend", 1, day(1), 6.0), ("spend", 9, day(3), 7.0)]) == 2
    assert stored(store, "a") == [
        ("spend", 1, 1, 6.0), ("spend", 1, 2, 3.0), ("spend", 2, 1, 2.0), ("spend", 3, 1, 5.0),
        ("spend", 9, 3, 7.0),
    ]
    assert stored(store, "b") == [("clicks", 1, 1, 4.0)]
    assert len(stored(store)) == 6


def test_a_version_counts_when_it_is_committed(store):
    put(store, "a", [("spend", 1, day(1), 1.0)])
    # What a writer leaves that dies before its commit
    lost = store.values.read().withColumn("value", F.lit(9.0))
    lost.write.partitionBy("view_name", "snapshot_date").parquet(f"{store.values.path}/version=2")
    assert stored(store) == [("spend", 1, 1, 1.0)]
    put(store, "a", [("spend", 1, day(1), 2.0)])
    assert stored(store) == [("spend", 1, 1, 2.0)]


def test_discarded_work_tables_are_empty(spark):
    frame = cut(spark.range(100))
    path = frame.inputFiles()[0].rpartition("/")[0]
    discard(frame)
    assert spark.read.parquet(path).count() == 0


def test_null_entities_match_nothing(spark):
    values = long_values(spark, [("spend", None, day(1), 1.0), ("spend", 1, day(1), 2.0)])
    requests = spark.range(2000).select(
        F.lit(None).cast("bigint").alias("entity_id"), F.lit(day(2)).alias("event_timestamp")
    )
    found = asof_join(requests, values, {"spend": None})
    assert found.where("spend IS NOT NULL").count() == 0 and found.count() == 2000


def test_parity_sees_entities_of_one_side(store):
    store.registry.apply(
        [FeatureView("v", "user", ttl=timedelta(days=2))], [FeatureDefinition("spend", "v")]
    )
    put(store, "v", [("spend", 1, day(1), 1.0)])
    materialize(store, "v", day(2))
    assert parity_differences(store, "v").count() == 0
    put(store, "v", [("spend", 2, day(2), 5.0)])
    assert rows_of(parity_differences(store, "v")) == [(2, "spend", None, 5.0)]


def test_an_unmeasured_model_is_not_promoted_over_a_champion(spark, store):
    frame = model_frame(spark)
    alike = frame.withColumn(
        "label", F.when(F.col("event_timestamp") >= F.lit(JUNE), 1).otherwise(F.col("label"))
    )
    first = train_and_register(store, alike, JUNE, promote_if_better=True)
    second = train_and_register(store, alike, JUNE, promote_if_better=True)
    assert (first.promoted, second.promoted) == (True, False)
    assert "roc_auc" not in second.metrics and second.champion_roc_auc is None
    assert store.models.champion(MODEL_NAME).version == "1"


def test_models_are_compared_at_the_recall_of_the_rule(spark):
    train, test = temporal_split(model_frame(spark), JUNE)
    found = compare_models({"logistic": fit_logistic(train)}, train, test)
    rows = {row["model"]: row for row in found.collect()}
    assert set(rows) == {"logistic", "ordered_last_30d"}
    assert len({row["recall"] for row in rows.values()}) == 1
    assert rows["logistic"]["test_roc_auc"] == pytest.approx(0.95)
    assert all(0 <= row["precision"] <= 1 for row in rows.values())


def orders_until(commerce, moments):
    """A label and a view over a grid of snapshots, as a caller would write them."""
    grid = commerce.users.sparkSession.createDataFrame(
        [(at,) for at in moments], "event_timestamp timestamp"
    )
    after = commerce.users.where("user_id < 3").join(F.broadcast(grid))
    orders = commerce.orders.withColumnRenamed("user_id", "buyer")
    earlier = (F.col("buyer") == F.col("user_id")) & (F.col("order_ts") < F.col("event_timestamp"))
    return (
        after.join(orders, earlier, "left")
        .groupBy(F.col("user_id").alias("entity_id"), "event_timestamp")
        .agg(F.count("order_id").alias("orders_so_far"))
    )


GRID_SQL = """
SELECT u.user_id AS entity_id, s.as_of AS event_timestamp, count(o.order_id) AS orders_so_far
FROM snapshots s JOIN users u ON u.user_id < 3
LEFT JOIN orders o ON o.user_id = u.user_id AND o.order_ts < s.as_of GROUP BY ALL"""
ONE_SQL = """
SELECT u.user_id AS entity_id, count(o.order_id) AS orders_so_far FROM users u
LEFT JOIN orders o ON o.user_id = u.user_id AND o.order_ts < :as_of
WHERE u.user_id < 3 GROUP BY ALL"""


def test_views_of_a_caller_agree(store):
    load(store, ORDERS)
    at = lambda commerce, moment: orders_until(commerce, [moment]).drop("event_timestamp")
    register_frame_view("grid", FrameView(at, orders_until))
    register_frame_view("single", FrameView(at))
    views = {"grid": None, "single": None, "grid_sql": GRID_SQL, "one_sql": ONE_SQL}
    found = {}
    for name, sql in views.items():
        store.registry.apply(
            [FeatureView(name, "user", source_sql=sql)], [FeatureDefinition("orders_so_far", name)]
        )
        assert backfill(store, name, date(2026, 3, 3), date(2026, 3, 6)) == 8
        assert compute_features(store, name, day(6)) == 0
        found[name] = stored(store, name)
    assert found["grid"] == found["single"] == found["grid_sql"] == found["one_sql"]
    assert ("orders_so_far", 1, 6, 2.0) in found["grid"]


@pytest.mark.parametrize(
    "sql, n_frames",
    [
        ("SELECT user_id AS entity_id, order_ts FROM orders WHERE order_ts < :as_of", 1),
        ("SELECT as_of AS event_timestamp, user_id AS entity_id, order_ts\n"
         "FROM orders JOIN snapshots ON order_ts < as_of", 1),
        # Spark cannot take this form apart: the moments are united
        ("SELECT user_id AS entity_id, order_ts FROM orders LEFT JOIN\n"
         "(SELECT 1 AS one FROM users WHERE signup_ts < :as_of LIMIT 1) ON true\n"
         "WHERE order_ts < :as_of", 2),
    ],
)
def test_kinds_of_sql_agree(store, sql, n_frames):
    load(store, ORDERS)
    moments = [day(number) for number in range(2, 8)]
    found = sql_parts(store.raw.read(), sql, moments, size=3)
    assert len(found) == n_frames
    rows = sorted(rows_of(sql_at(store.raw.read(), sql, moments), "event_timestamp", "entity_id", "order_ts"))
    orders = rows_of(store.raw.read().orders, "user_id", "order_ts")
    plain = [(at.replace(tzinfo=None), *o) for at in moments for o in orders if o[1] < at.replace(tzinfo=None)]
    assert rows == sorted(plain) and rows


def test_sql_without_a_moment_is_the_same_at_each(store):
    load(store, ORDERS)
    sql = "SELECT user_id AS entity_id, ':as_of' AS `:as_of` FROM users /* :as_of */ -- :as_of"
    found = sql_at(store.raw.read(), sql, [day(2), day(3)])
    users = [row.user_id for row in store.raw.read().users.collect()]
    assert sorted(rows_of(found, "entity_id", ":as_of")) == sorted((u, ":as_of") for u in users * 2)
    assert with_moment("a = :as_of -- :as_of\nAND ':as_of' = :as_ofs", "x") == (
        "a = x -- :as_of\nAND ':as_of' = :as_ofs", 1
    )


def test_sql_leaves_the_views_of_the_caller(store):
    load(store, ORDERS)
    store.spark.range(7).createOrReplaceTempView("users")
    store.registry.apply(
        [FeatureView("v", "user", source_sql=ONE_SQL)], [FeatureDefinition("orders_so_far", "v")]
    )
    assert compute_features(store, "v", day(6)) == 2
    assert store.spark.table("users").count() == 7
    store.spark.catalog.dropTempView("users")


def test_labels_of_a_caller_agree(store):
    load(store, [*ORDERS, (3, day(28), "1")])
    apply_definitions(store)
    moments, horizon = [day(3), day(5)], timedelta(days=2)
    backfill(store, VIEW, date(2026, 3, 3), date(2026, 3, 5))
    by_sql = """
        SELECT u.user_id AS entity_id, s.as_of AS event_timestamp,
               CAST(count(o.order_id) > 0 AS INT) AS label
        FROM snapshots s JOIN users u ON u.signup_ts < s.as_of
        LEFT JOIN orders o ON o.user_id = u.user_id AND o.order_ts >= s.as_of
                          AND o.order_ts < s.as_of + INTERVAL '2' DAY GROUP BY ALL"""
    by_frame = lambda raw, at: bought_within(raw.users, raw.orders, at, horizon)
    labels = [
        Label("plain", horizon), Label("sql", horizon, by_sql), Label("f", horizon, frame=by_frame)
    ]
    found = [
        sorted(rows_of(build_training_set(store, moments, ["view_count_7d"], label)))
        for label in labels
    ]
    assert found[0] == found[1] == found[2] and found[0]


def test_predictions_of_some_days_prune_partitions(spark, store):
    columns = (
        "model_name string, model_version string, entity_id bigint, predicted_at timestamp, "
        "probability double, features map<string,double>, features_as_of timestamp"
    )
    rows = [("m", "1", n, day(n), 0.5, {"a": 1.0}, day(1)) for n in (1, 2, 3)]
    store.predictions.write(spark.createDataFrame(rows, columns), "j", 0)
    found = store.predictions.between("m", date(2026, 3, 2), date(2026, 3, 3))
    assert sorted(rows_of(found, "entity_id")) == [(2,), (3,)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "day" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_publishing_does_not_wait_for_monitoring(store, monkeypatch):
    load(store, ORDERS)
    apply_definitions(store)

    def broken(*_):
        raise RuntimeError("no monitoring today")

    monkeypatch.setattr(jobs, "monitor_features", broken)
    with pytest.raises(RuntimeError):
        run_daily(store, VIEW, day(6))
    assert store.online.until(VIEW) == day(6)
    assert MAY < JUNE
