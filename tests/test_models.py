"""Metrics, the purchase model, promotion, retraining, scoring and the scheduled jobs."""

import random
from datetime import date, timedelta
from decimal import Decimal

import numpy as np
import pytest
from conftest import day, put, rows_of
from pyspark.sql import functions as F

from tidemark.operators.metrics import (
    classification_metrics,
    precision_at_recall,
    ranking,
    roc_auc,
    score_counts,
)
from tidemark.plans.jobs import InvalidSnapshotError, apply_definitions, run_daily, run_weekly
from tidemark.plans.modeling import (
    MODEL_FEATURES,
    MODEL_NAME,
    MODEL_VIEW,
    baselines,
    fit_boosting,
    fit_logistic,
    measured_auc,
    score,
    temporal_split,
    train_and_register,
    weights,
)
from tidemark.plans.monitoring import monitor_features
from tidemark.plans.publish import materialize
from tidemark.plans.retraining import performance_check, retrain, retrain_reasons
from tidemark.plans.training import Label, build_training_set
from tidemark.sources import schemas
from tidemark.sources.registry import FeatureDefinition
from tidemark.streaming.scoring import score_and_log, score_stream

ACTIVE = (3.0, 40.0, 2.0, 9.0)
INACTIVE = (0.0, None, None, 0.0)
MAY, JUNE = day(1, month=5), day(1, month=6)
FRAME = (
    "entity_id bigint, event_timestamp timestamp, "
    + ", ".join(f"{name} double" for name in MODEL_FEATURES)
    + ", label int"
)


def model_frame(spark, flip_may=False):
    """Even users are active and buy, odd ones do neither; users 0 and 1 do the opposite."""
    rows = []
    for month in (MAY, JUNE):
        for user in range(40):
            buys = (user % 2 == 0) != (user < 2)
            label = int(buys) if not (flip_may and month == MAY) else int(not buys)
            rows.append((user, month, *(ACTIVE if user % 2 == 0 else INACTIVE), label))
    return spark.createDataFrame(rows, FRAME)


def exact_auc(pairs):
    positive = [s for s, y in pairs if y]
    negative = [s for s, y in pairs if not y]
    wins = sum((p > n) + (p == n) / 2 for p in positive for n in negative)
    return wins / (len(positive) * len(negative))


@pytest.mark.parametrize("slices", [1, 5])
def test_ranking_metrics(spark, slices):
    rng = random.Random(4)
    pairs = [(rng.randrange(25) / 5, int(rng.random() < 0.4)) for _ in range(200)]
    counts = score_counts(spark.createDataFrame(pairs, "score double, label int"))
    assert roc_auc(counts, slices=slices).first()[0] == pytest.approx(exact_auc(pairs))
    buyers = sum(y for _, y in pairs)
    for wanted in (0.0, 0.3, 0.75, 1.0):
        best = 1.0 if wanted == 0 else 0.0
        for cut_off in {s for s, _ in pairs}:
            chosen = [y for s, y in pairs if s >= cut_off]
            if sum(chosen) / buyers >= wanted:
                best = max(best, sum(chosen) / len(chosen))
        found = precision_at_recall(counts, wanted, slices=slices).first()[0]
        assert found == pytest.approx(best)


@pytest.mark.parametrize("slices", [1, 7])
def test_ranking_of_several_scores_in_one_pass(spark, slices):
    """The same as one metric at a time, for parts of one label, repeated scores and lost labels."""
    rng = random.Random(8)
    rows = [(rng.randrange(2), rng.random(), rng.choice([0, 0, 1, None])) for _ in range(400)]
    rows += [(2, 0.5, 0), (2, 0.25, 0), (3, 0.5, None)]
    frame = spark.createDataFrame(rows, "part int, fine double, label int").repartition(3)
    frame = frame.withColumn("rough", F.round("fine", 1))
    found = ranking(frame, ["fine", "rough"], 0.4, slices)
    assert set(found) == {(name, part) for name in ("fine", "rough") for part in range(4)}
    for name, part in found:
        own = frame.where(F.col("part") == part).withColumn("score", F.col(name))
        counts = score_counts(own)
        expected = (None, None)
        if part < 2:
            expected = roc_auc(counts).first()[0], precision_at_recall(counts, 0.4).first()[0]
        assert found[name, part] == pytest.approx(expected)
    assert ranking(frame, ["fine"], 0.0, slices)["fine", 0][1] == 1.0


def test_classification_metrics(spark):
    rows = [(1, 1), (1, 0), (0, 1), (0, 0), (0, 0)]
    frame = spark.createDataFrame(rows, "prediction int, label int")
    assert rows_of(classification_metrics(frame)) == [(0.6, 0.5, 0.5, 0.4)]
    nobody = frame.withColumn("prediction", F.lit(0))
    assert rows_of(classification_metrics(nobody)) == [(0.6, 0.0, 0.0, 0.4)]


def test_baselines(spark):
    both = baselines(temporal_split(model_frame(spark), JUNE)[1])
    found = {r["model"]: r for r in classification_metrics(both, ["model"]).collect()}
    assert found["always_no"]["recall"] == 0
    assert found["ordered_last_30d"]["accuracy"] == pytest.approx(0.95)


def test_logistic_regression_is_the_penalised_optimum(spark):
    """Against Newton's method on the sum of log losses plus half the squared weights."""
    rng = random.Random(8)
    rows = []
    for n in range(120):
        x = [rng.gauss(0, 2), rng.random() * 50, None if n % 5 == 0 else rng.gauss(5, 1), 1.0]
        label = int(rng.random() < 1 / (1 + np.exp(-x[0])))
        rows.append((n, MAY, *x, label))
    frame = spark.createDataFrame(rows, FRAME)
    model = fit_logistic(frame)
    table = np.array([[np.nan if v is None else v for v in row[2:6]] for row in rows])
    gaps = np.isnan(table[:, [2]]).astype(float)
    filled = np.where(np.isnan(table), np.nanmedian(table, axis=0), table)
    inputs = np.hstack([filled, gaps])
    spread = inputs.std(axis=0)
    z = (inputs - inputs.mean(axis=0)) / np.where(spread == 0, 1, spread)
    z1, y = np.hstack([z, np.ones((120, 1))]), np.array([row[6] for row in rows])
    w, penalty = np.zeros(6), np.diag([1.0] * 5 + [0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-z1 @ w))
        hessian = z1.T @ (z1 * (p * (1 - p))[:, None]) + penalty
        w -= np.linalg.solve(hessian, z1.T @ (p - y) + penalty @ w)
    names = [f"z_{n}" for n in MODEL_FEATURES] + ["z_missing_days_since_last_order"]
    assert dict(weights(model)) == pytest.approx(dict(zip(names, w[:5], strict=True)), abs=1e-4)
    scored = score(model, frame).orderBy("entity_id")
    expected = 1 / (1 + np.exp(-z1 @ w))
    assert np.allclose([r[0] for r in rows_of(scored, "score")], expected, atol=1e-4)
    assert [r[0] for r in rows_of(scored, "prediction")] == [int(p > 0.5) for p in expected]


def test_training_needs_values_and_both_sides(spark, store):
    frame = model_frame(spark).withColumn(MODEL_FEATURES[1], F.lit(None).cast("double"))
    with pytest.raises(ValueError, match="without any value"):
        fit_logistic(frame)
    with pytest.raises(ValueError, match="leaves 80 train, 0 test rows"):
        train_and_register(store, model_frame(spark), day(1, month=7))


def test_boosting_learns_the_pattern(spark):
    train, test = temporal_split(model_frame(spark), JUNE)
    assert measured_auc(score(fit_boosting(train, trees=3), test)) > 0.9


def test_promotion_needs_a_better_score(spark, store):
    assert store.models.champion(MODEL_NAME) is None
    first = train_and_register(store, model_frame(spark), JUNE, promote_if_better=True)
    assert (first.version, first.promoted, first.champion_roc_auc) == ("1", True, None)
    assert (first.train_rows, first.test_rows) == (40, 40)
    assert first.metrics["roc_auc"] == pytest.approx(0.95)
    champion = store.models.champion(MODEL_NAME)
    assert champion.test_roc_auc == first.metrics["roc_auc"]
    assert {row["feature_name"] for row in champion.reference.collect()} == set(MODEL_FEATURES)
    assert champion.params["train_rows"] == "40"

    same = train_and_register(store, model_frame(spark), JUNE, promote_if_better=True)
    assert (same.version, same.promoted) == ("2", False)
    assert same.champion_roc_auc == pytest.approx(first.metrics["roc_auc"])
    assert store.models.champion(MODEL_NAME).version == "1"

    worse = train_and_register(store, model_frame(spark, flip_may=True), JUNE)
    assert worse.promoted and worse.metrics["roc_auc"] < 0.5
    assert store.models.champion(MODEL_NAME).version == "3"
    better = train_and_register(store, model_frame(spark), JUNE, promote_if_better=True)
    assert better.promoted and better.champion_roc_auc == worse.metrics["roc_auc"]


@pytest.fixture
def shop(store):
    """Twenty users over five months. Even ones order every tenth day, odd ones hardly ever."""
    rng = random.Random(9)
    spark, start = store.spark, day(1, month=1)
    users = [(n, start - timedelta(days=5)) for n in range(20)]
    orders, views = [], []
    for user in range(20):
        for offset in range(150):
            at = start + timedelta(days=offset, hours=rng.randrange(24))
            if rng.random() < (0.1 if user % 2 == 0 else 0.004):
                orders.append((len(orders), user, at, Decimal(rng.randrange(5, 50))))
            if rng.random() < (0.5 if user % 2 == 0 else 0.1):
                views.append((len(views), user, 1, at))
    # The raw data ends with May
    orders.append((len(orders), 0, start + timedelta(days=150), Decimal(1)))
    store.raw.replace_tables(
        {
            "users": spark.createDataFrame(users, schemas.USERS),
            "orders": spark.createDataFrame(orders, schemas.ORDERS),
            "product_views": spark.createDataFrame(views, schemas.PRODUCT_VIEWS),
        }
    )
    apply_definitions(store)
    return store


def fill(store, *moments):
    from tidemark.plans.compute import view_values
    from tidemark.plans.purchase_stats import purchase_stats_at

    wide = purchase_stats_at(store.raw.read(), list(moments))
    values = view_values(wide, MODEL_VIEW, MODEL_FEATURES, F.col("event_timestamp"))
    store.values.upsert(values)


def test_retraining(shop):
    """As of 25 May the test set is 25 April; training uses months closed before it."""
    as_of = day(25, month=5)
    assert retrain_reasons(shop, as_of) == ["there is no champion model yet"]
    with pytest.raises(ValueError, match="No training snapshots"):
        retrain(shop, day(15), date(2026, 2, 1))
    fill(shop, day(1, month=2), day(1), day(25, month=4), as_of)
    reasons, result = run_weekly(shop, as_of, date(2026, 2, 1))
    assert reasons == ["there is no champion model yet"]
    assert (result.train_rows, result.test_rows, result.promoted) == (40, 20, True)

    champion = shop.models.champion(MODEL_NAME)
    check = performance_check(shop, champion, as_of).first()
    assert check["value"] == pytest.approx(champion.test_roc_auc)
    assert check["status"] == "ok"
    assert "on the snapshot of 2026-04-25" in check["message"]
    with pytest.raises(ValueError, match="not final"):
        performance_check(shop, champion, day(20, month=7))

    # Twenty users differ a lot from month to month, so drift is found; the score is as it was
    reasons = retrain_reasons(shop, as_of)
    assert all("has drifted" in reason for reason in reasons)
    logged = rows_of(shop.monitor.read(), "kind", "name", "metric")
    assert ("model", MODEL_NAME, "roc_auc") in logged
    assert {name for kind, name, _ in logged if kind == "feature"} == set(MODEL_FEATURES)
    checks, note = monitor_features(shop, MODEL_VIEW, as_of)
    assert note is None and checks.where("metric = 'psi'").count() == 4


def test_training_set_rows_and_leakage(shop):
    fill(shop, day(1), day(1, month=4))
    label = Label("soon", timedelta(days=30))
    frame = build_training_set(shop, [day(1), day(1, month=4)], MODEL_FEATURES, label)
    assert frame.columns == ["entity_id", "event_timestamp", *MODEL_FEATURES, "label"]
    assert frame.count() == 40
    own = Label("views", timedelta(days=1),
                "SELECT user_id AS entity_id, CAST(user_id % 2 AS INT) AS label FROM users")
    by_sql = build_training_set(shop, [day(1)], MODEL_FEATURES[:1], own)
    assert by_sql.agg(F.sum("label")).first()[0] == 10
    # A value stamped after the snapshot changes nothing
    before = sorted(rows_of(build_training_set(shop, [day(1)], MODEL_FEATURES)), key=str)
    put(shop, MODEL_VIEW, [(MODEL_FEATURES[0], 1, day(1, 1), 999.0)])
    after = sorted(rows_of(build_training_set(shop, [day(1)], MODEL_FEATURES)), key=str)
    assert before == after


def test_daily_run_publishes_only_valid_values(shop):
    run = run_daily(shop, MODEL_VIEW, day(1))
    assert (run.written, run.published) == (80, 20)
    assert run_daily(shop, MODEL_VIEW, day(1)).written == 0
    shop.registry.register_feature(
        FeatureDefinition("view_count_7d", MODEL_VIEW, expected_max=0.5)
    )
    with pytest.raises(InvalidSnapshotError, match="view_count_7d: maximum"):
        run_daily(shop, MODEL_VIEW, day(2))
    assert shop.online.until(MODEL_VIEW) == day(1)
    logged = shop.monitor.read().where(F.col("snapshot_at") == F.lit(day(2)))
    assert logged.where("metric = 'maximum' AND status = 'alert'").count() == 1


@pytest.fixture
def serving(spark, store):
    apply_definitions(store)
    rows = [
        (name, entity, day(1), value)
        for entity, features in ((1, ACTIVE), (2, INACTIVE))
        for name, value in zip(MODEL_FEATURES, features, strict=True)
    ]
    put(store, MODEL_VIEW, rows)
    materialize(store, MODEL_VIEW, day(2))
    return store


def test_scoring_in_batch(spark, serving):
    requests = spark.createDataFrame([(1,), (2,), (99,)], "entity_id bigint")
    with pytest.raises(LookupError):
        score_and_log(serving, requests, "api", 0)
    train_and_register(serving, model_frame(spark), JUNE)
    for _ in range(2):  # the same batch again is logged once
        score_and_log(serving, requests, "api", 0, predicted_at=day(2))
    logged = {row["entity_id"]: row for row in serving.predictions.read().collect()}
    assert set(logged) == {1, 2} and serving.predictions.read().count() == 2
    assert logged[1]["probability"] > 0.5 > logged[2]["probability"]
    assert logged[2]["features"] == dict(zip(MODEL_FEATURES, INACTIVE, strict=True))
    assert logged[1]["features_as_of"].day == 1
    assert (logged[1]["model_name"], logged[1]["model_version"]) == (MODEL_NAME, "1")
    rejected = spark.read.parquet(f"{serving.root}/rejected")
    assert rows_of(rejected, "entity_id") == [(99,)]
    in_march = serving.predictions.between(MODEL_NAME, date(2026, 3, 1), date(2026, 3, 31))
    assert in_march.count() == 2


def test_scoring_as_a_stream(spark, serving, tmp_path):
    train_and_register(serving, model_frame(spark), JUNE)
    source, progress = str(tmp_path / "requests"), str(tmp_path / "progress")
    write = lambda *ids: spark.createDataFrame(
        [(n,) for n in ids], "entity_id bigint"
    ).coalesce(1).write.mode("append").parquet(source)

    def run():
        stream = spark.readStream.schema("entity_id bigint").parquet(source)
        score_stream(serving, stream, "stream", progress).awaitTermination()
        return sorted(rows_of(serving.predictions.read(), "entity_id", "batch", "model_version"))

    write(1, 99)
    assert run() == [(1, 0, "1")]
    train_and_register(serving, model_frame(spark), JUNE)
    write(2, 2)
    # The new champion scores the new batch; the old one is not scored again
    assert run() == [(1, 0, "1"), (2, 1, "2"), (2, 1, "2")]
