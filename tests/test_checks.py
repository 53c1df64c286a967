"""Quality, freshness, drift, the monitor log and its status."""

import math
import random
import statistics
from bisect import bisect_left

import pytest
from conftest import day, long_values, put, rows_of
from pyspark.sql import functions as F

from tidemark.operators.drift import (
    PSI_ALERT,
    deciding_counts,
    drift_checks,
    quantile_edges,
    quantiles,
    reference_distribution,
    stability_index,
    value_counts,
)
from tidemark.operators.explore import (
    describe,
    exploration_report,
    label_rate,
    label_rate_by_snapshot,
    means_by_label,
    missing_share,
)
from tidemark.operators.reshape import to_long
from tidemark.plans.monitoring import (
    freshness,
    monitor_features,
    monitor_status,
    snapshot_quality,
    validate_snapshot,
)
from tidemark.sources.registry import (
    DEPRECATED,
    TESTING,
    FeatureDefinition,
    FeatureView,
    NotRegisteredError,
)


@pytest.fixture
def checked(store):
    store.registry.apply(
        [FeatureView("v", "user")],
        [
            FeatureDefinition("spend", "v", expected_min=0, expected_max=100, null_threshold=0.25),
            FeatureDefinition("clicks", "v", status=TESTING, null_threshold=0, freshness_hours=48),
            FeatureDefinition("old", "v", status=DEPRECATED),
        ],
    )
    return store


def put_snapshot(store, at, **features):
    put(
        store,
        "v",
        [
            (name, entity, at, value)
            for name, values in features.items()
            for entity, value in enumerate(values)
        ],
    )


def test_quality_at_the_limits_is_fine(checked):
    put_snapshot(checked, day(1), spend=[0.0, 50.0, 100.0, None], clicks=[1.0])
    assert validate_snapshot(checked, "v", day(1)) == []
    found = rows_of(snapshot_quality(checked, "v", day(1)), "name", "metric", "value", "message")
    assert sorted(found) == [
        ("clicks", "null_share", 0.0, "0.0% of values are null, allowed 0.0%"),
        ("clicks", "row_count", 1.0, "1 values"),
        ("spend", "maximum", 100.0, "maximum 100, expected at most 100"),
        ("spend", "minimum", 0.0, "minimum 0, expected at least 0"),
        ("spend", "null_share", 0.25, "25.0% of values are null, allowed 25.0%"),
        ("spend", "row_count", 4.0, "4 values"),
    ]


def test_quality_names_every_problem(checked):
    put_snapshot(checked, day(1), spend=[-5.0, 50.0, 1234567.5])
    put_snapshot(checked, day(2), spend=[10.0, None, None, 20.0], clicks=[None, None])
    assert validate_snapshot(checked, "v", day(1)) == [
        "clicks: no values for 2026-03-01T00:00:00+00:00",
        "spend: maximum 1.23457e+06 is above the expected 100",
        "spend: minimum -5 is below the expected 0",
    ]
    assert validate_snapshot(checked, "v", day(2)) == [
        "clicks: 100.0% of values are null, allowed 0.0%",
        "spend: 50.0% of values are null, allowed 25.0%",
    ]


def test_quality_of_unknown_and_empty_views(checked):
    with pytest.raises(NotRegisteredError):
        snapshot_quality(checked, "typo", day(1))
    checked.registry.register_view(FeatureView("bare", "user"))
    assert validate_snapshot(checked, "bare", day(1)) == ["bare: the view has no features"]


def test_freshness(checked):
    checked.registry.register_feature(FeatureDefinition("never", "v"))
    put_snapshot(checked, day(1), clicks=[1.0], spend=[1.0])
    put_snapshot(checked, day(2), spend=[1.0])
    put_snapshot(checked, day(9), spend=[1.0], clicks=[1.0])
    found = rows_of(freshness(checked, day(3, 6)), "name", "value", "status", "message")
    # Only active features: `clicks` is in testing
    assert sorted(found) == [
        ("never", None, "alert", "no values at all"),
        ("spend", 30.0, "alert", "newest values are 30.0 hours old, allowed 24"),
    ]
    assert rows_of(freshness(checked, day(2, 6)).where("name = 'spend'"), "status") == [("ok",)]


def distribution(spark, values):
    frame = long_values(spark, [("x", n, day(1), v) for n, v in enumerate(values)])
    return reference_distribution(frame)


def expected_shares(values, edges):
    counts = [0] * (len(edges) + 2)
    for value in values:
        missing = value is None or value != value
        counts[-1 if missing else bisect_left(edges, value)] += 1
    return [count / len(values) for count in counts]


@pytest.mark.parametrize(
    "values",
    [
        [float(n) for n in range(1, 101)],
        [0.0] * 6 + [1.0, 2.0, None, float("nan")],
        [float(n % 17) for n in range(500)],
        [n * 0.1 for n in range(91)],
        [5.0] * 30,
        [5.0],
        [None, None],
        [random.Random(1).gauss(0, 9) for _ in range(777)],
    ],
)
def test_reference_matches_exact_quantiles(spark, values):
    present = [v for v in values if v is not None and v == v]
    edges = (
        sorted(set(statistics.quantiles(present, n=10, method="inclusive")))
        if len(present) > 1
        else []
    )
    (row,) = distribution(spark, values).collect()
    assert row["edges"] == edges
    assert row["shares"] == pytest.approx(expected_shares(values, edges))


def test_edges_by_slices(spark):
    rng = random.Random(2)
    values = [("a", float(rng.randrange(1000))) for _ in range(800)]
    values += [("b", rng.random()) for _ in range(400)]
    frame = long_values(spark, [(f, n, day(1), v) for n, (f, v) in enumerate(values)])
    counts = value_counts(frame)
    for slices in (1, 7):
        found = dict(rows_of(quantile_edges(counts, 10, slices)))
        for name in "ab":
            own = [v for f, v in values if f == name]
            assert found[name] == sorted(set(statistics.quantiles(own, n=10, method="inclusive")))


def psi(spark, before, after):
    frame = long_values(spark, [("x", n, day(2), v) for n, v in enumerate(after)])
    index = stability_index(distribution(spark, before), value_counts(frame))
    return index.first()["psi"]


def test_only_deciding_values_are_counted_one_by_one(spark):
    """Columns of distinct values: the same quantiles, out of a small part of the values."""
    rng = random.Random(3)
    wide = [
        (rng.uniform(-8, 8), rng.choice([None, float("nan"), -0.0, 0.0, 2.5, rng.random()]), n % 3)
        for n in range(200_000)
    ]
    frame = spark.createDataFrame(wide, "a double, b double, c int").repartition(3)
    frame = frame.withColumn("gone", F.lit(None).cast("double"))
    frame = frame.withColumn("once", F.when(F.col("a") == wide[0][0], 4.0))
    names = frame.columns
    every, deciding = value_counts(to_long(frame, names, [])), deciding_counts(frame, names, 8)
    for bins in (2, 8):
        expected = sorted(rows_of(quantiles(every, bins)))
        assert sorted(rows_of(quantiles(deciding, bins))) == expected
        assert {name for name, *_ in expected} == {"a", "b", "c"}
    present = every.where("value IS NOT NULL")
    sums = lambda counts: sorted(
        rows_of(counts.groupBy("feature_name").agg(F.sum("n"), F.max("value")))
    )
    assert sums(deciding) == sums(present)
    assert deciding.count() < present.count() / 2


def test_stability_index(spark):
    base = [float(n) for n in range(1000)]
    shifted = [psi(spark, base, [v + by for v in base]) for by in (0, 30, 400)]
    assert shifted[0] == 0
    assert 0 < shifted[1] < 0.1 < PSI_ALERT < shifted[2] < math.inf
    assert psi(spark, base, [v if v % 2 else None for v in base]) > PSI_ALERT
    assert math.isfinite(psi(spark, [5.0] * 20, [6.0] * 20))


def test_drift_grading(spark):
    base = [float(n) for n in range(200)]
    reference = distribution(spark, base)
    rows = lambda by: [("x", n, day(2), v + by) for n, v in enumerate(base)]
    check = lambda frame: rows_of(drift_checks(reference, frame, day(2)))[0]
    name, metric, value, status, message = check(long_values(spark, rows(0)))
    assert (name, metric, value, status) == ("x", "psi", 0.0, "ok")
    assert message == (
        "PSI 0.000 against the model's training data (warning from 0.1, alert from 0.25)"
    )
    assert check(long_values(spark, rows(150)))[3] == "alert"
    assert check(long_values(spark, [])) == (
        "x", "psi", None, "warning", "not checked: no values for 2026-03-02T00:00:00+00:00",
    )


CHECKS = "name string, metric string, value double, status string, message string"


def log(store, kind, at, *checks, now=None):
    store.monitor.log(kind, at, store.spark.createDataFrame(list(checks), CHECKS), now)


def test_log_replaces_same_snapshot_only(checked):
    null_share = ("spend", "null_share", 0.5, "alert", "bad")
    log(checked, "feature", day(2), null_share, ("spend", "psi", 0.1, "ok", "p"), now=day(2))
    log(checked, "feature", day(3), null_share, now=day(3))
    log(checked, "feature", day(2), ("spend", "null_share", 0.0, "ok", "good"), now=day(4))
    found = rows_of(checked.monitor.read(), "metric", "snapshot_at", "status", "checked_at")
    assert sorted((m, s.day, st, c.day) for m, s, st, c in found) == [
        ("null_share", 2, "ok", 4), ("null_share", 3, "alert", 3), ("psi", 2, "ok", 2),
    ]
    with pytest.raises(ValueError):
        log(checked, "table", day(2), null_share)


def test_status_takes_the_latest_and_the_worst(checked):
    put_snapshot(checked, day(3), spend=[1.0])
    log(checked, "feature", day(2), ("spend", "null_share", 0.5, "alert", "bad"))
    log(checked, "feature", day(3), ("spend", "null_share", 0.0, "ok", "good"),
        ("spend", "psi", 0.2, "warning", "moved"))
    log(checked, "model", day(3), ("m", "roc_auc", 0.9, "ok", "fine"))
    row = monitor_status(checked, day(3, 12)).first()
    assert row["status"] == "warning"
    assert set(row["features"]) == {"spend"} and set(row["models"]) == {"m"}
    assert row["features"]["spend"]["status"] == "warning"
    assert [c["metric"] for c in row["features"]["spend"]["checks"]] == [
        "freshness_hours", "null_share", "psi",
    ]
    assert row["models"]["m"]["checks"][0]["value"] == 0.9
    assert monitor_status(checked, day(2, 12)).first()["status"] == "alert"


def test_status_of_nothing_is_ok(store):
    row = monitor_status(store, day(1)).first()
    assert (row["status"], row["features"], row["models"]) == ("ok", {}, {})


def test_monitor_without_champion_logs_quality(checked):
    put_snapshot(checked, day(1), spend=[1.0], clicks=[None])
    checks, note = monitor_features(checked, "v", day(1))
    assert note == "drift not checked: there is no champion model yet"
    assert checks.count() == checked.monitor.read().count() == 6


def test_exploration(spark):
    rows = [(1, day(1), 1.0, None, 1), (2, day(1), 2.0, 4.0, 0), (3, day(2), 4.0, 5.0, 0)]
    frame = spark.createDataFrame(
        rows, "entity_id bigint, event_timestamp timestamp, a double, b double, label int"
    )
    assert label_rate(frame).first()[0] == pytest.approx(1 / 3)
    rates = {at and at.day: rate for at, rate in rows_of(label_rate_by_snapshot(frame))}
    assert rates == {None: pytest.approx(1 / 3), 1: 0.5, 2: 0.0}
    assert dict(rows_of(missing_share(frame, ["a", "b"]))) == {"a": 0, "b": pytest.approx(1 / 3)}
    assert sorted(rows_of(means_by_label(frame, ["a", "b"]))) == [(0, 3.0, 4.5), (1, 1.0, None)]
    found = {row["column_name"]: row for row in describe(frame, ["a", "b"]).collect()}
    assert found["a"].asDict() == {
        "column_name": "a", "count": 3, "mean": pytest.approx(7 / 3),
        "std": pytest.approx(statistics.stdev([1, 2, 4])), "min": 1.0, "q25": 1.5, "q50": 2.0,
        "q75": 3.0, "max": 4.0,
    }
    report = exploration_report(frame, ["a", "b"])
    assert {name: part.count() for name, part in report.items()} == {
        "describe": 2, "label_rate": 3, "missing_share": 2, "means_by_label": 2,
    }
