"""The point-in-time join: never the future, never expired, never past a stored null."""

import random
from datetime import timedelta

import pytest
from conftest import day, long_values, put, rows_of
from pyspark.sql import functions as F

from tidemark.operators.asof import asof_join
from tidemark.operators.hot import hot_keys, lookup_join, running_totals
from tidemark.plans.historical import (
    exploded_requests,
    features_at,
    historical_features,
    request_rows,
)
from tidemark.session import cut
from tidemark.sources.registry import FeatureDefinition, FeatureView, NotRegisteredError

HOUR, TICK = timedelta(hours=1), timedelta(microseconds=1)
# Machines report these; a firmware stays until the next one.
TTLS = {"temperature": 30 * HOUR, "load": 2 * HOUR, "firmware": None}


def ask(spark, values, requests, features=tuple(TTLS), **options):
    frame = request_rows(spark, requests)
    ttls = {name: TTLS[name] for name in features}
    answers = asof_join(frame, long_values(spark, values), ttls, **options)
    return rows_of(answers.orderBy("row_id"), *features)


@pytest.mark.parametrize("hot_rows", [None, 3])
def test_at_the_edges_of_every_validity(spark, hot_rows):
    """A tick before and after each value begins and ends to count, with nulls and gaps between."""
    values = [
        (name, machine, day(4) + machine * 7 * HOUR + n * 5 * HOUR, None if n == 2 else 10.0 * n)
        for name in TTLS
        for machine in (1, 2)
        for n in (0, 1, 2, 5, 6)
    ]
    moments = {
        (machine, at + tick)
        for name, machine, ts, _ in values
        for at in (ts, ts + (TTLS[name] or 100 * HOUR))
        for tick in (-TICK, 0 * TICK, TICK)
    }
    requests = [*sorted(moments), (3, day(5)), (1, day(1))]
    assert ask(spark, values, requests, hot_rows=hot_rows) == brute_force(values, requests, TTLS)


def test_rows_keep_their_order_and_repeats(spark):
    values = [("load", 4, day(2), 0.25), ("load", 5, day(2), float("nan"))]
    requests = [(5, day(2)), (4, day(2)), (None, day(2)), (4, day(2)), (6, day(2))]
    for hot_rows in (None, 1):
        nan, *others = ask(spark, values, requests, ["load"], hot_rows=hot_rows)
        assert nan[0] != nan[0]
        assert others == [(0.25,), (None,), (0.25,), (None,)]


def test_requests_as_lists_of_moments_or_texts(spark):
    """The same two requests: the second is before the value, by an hour or by its offset."""
    ids, moments = [7, 8], [day(2, 12), day(2, 11)]
    texts = ["2026-03-02T13:00:00+01:00", "2026-03-02 11:00:00"]
    schema = "shift string, entity_ids array<bigint>, timestamps array<{}>"
    values = long_values(spark, [("load", machine, day(2, 12), 0.5) for machine in ids])
    for kind, stamps in (("timestamp", moments), ("string", texts)):
        lists = spark.createDataFrame([("late", ids, stamps)], schema.format(kind))
        requests = exploded_requests(lists)
        assert requests.columns == ["shift", "row_id", "entity_id", "event_timestamp"]
        joined = asof_join(requests, values, {"load": None}).orderBy("row_id")
        assert rows_of(joined, "shift", "row_id", "entity_id", "load") == [
            ("late", 0, 7, 0.5), ("late", 1, 8, None)
        ]


def test_no_requests(spark):
    assert ask(spark, [("load", 1, day(1), 10.0)], []) == []


def brute_force(values, requests, ttls):
    answers = []
    for entity, at in requests:
        row = []
        for name, ttl in ttls.items():
            seen = [
                (ts, value)
                for feature, owner, ts, value in values
                if feature == name and owner == entity and ts <= at
                and (ttl is None or ts >= at - ttl)
            ]
            row.append(max(seen, key=lambda pair: pair[0])[1] if seen else None)
        answers.append(tuple(row))
    return answers


@pytest.mark.parametrize("hot_rows", [None, 5_000_000, 40, 7])
def test_agrees_with_brute_force_on_skewed_data(spark, hot_rows):
    """A third of all rows on one entity, and a pile of equal requests at one moment."""
    rng = random.Random(5)
    entity = lambda: 1 if rng.random() < 0.34 else rng.randrange(2, 9)
    moment = lambda: day(1) + timedelta(hours=rng.randrange(240))
    stored = {}
    for _ in range(300):
        key = (rng.choice(list(TTLS)), entity(), moment())
        stored[key] = None if rng.random() < 0.2 else float(rng.randrange(100))
    values = [(*key, value) for key, value in stored.items()]
    requests = [(entity(), moment()) for _ in range(150)] + [(1, day(4, 5))] * 60
    found = ask(spark, values, requests, list(TTLS), hot_rows=hot_rows)
    assert found == brute_force(values, requests, TTLS)


def test_pruned_join_gives_the_same(spark):
    rng = random.Random(6)
    values = [
        (name, entity, day(1) + timedelta(hours=6 * n), float(rng.randrange(50)))
        for name in TTLS
        for entity in range(1, 6)
        for n in range(80)
    ]
    requests = [(rng.randrange(1, 7), day(rng.choice([5, 12]), rng.randrange(24)))
                for _ in range(30)]
    frame = request_rows(spark, requests)
    stored = long_values(spark, values).withColumn("snapshot_date", F.to_date("event_timestamp"))
    found = rows_of(features_at(frame, stored, TTLS).orderBy("row_id"), *TTLS)
    assert found == brute_force(values, requests, TTLS)


def test_plan_has_one_shuffle_and_no_nested_loop(spark):
    requests = request_rows(spark, [(1, day(1))])
    values = long_values(spark, [("load", 1, day(1), 1.0)])
    joined = asof_join(requests, values, TTLS, hot_rows=None)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_store_reads_only_visible_days(store):
    store.registry.apply(
        [FeatureView("hourly", "machine", ttl=26 * HOUR), FeatureView("changes", "machine")],
        [FeatureDefinition("load", "hourly"), FeatureDefinition("firmware", "changes")],
    )
    put(store, "hourly", [("load", 1, day(n), float(n)) for n in range(1, 11)])
    put(store, "changes", [("firmware", 1, day(2), 2.5), ("firmware", 2, day(9, 1), 3.0)])
    requests = request_rows(store.spark, [(1, day(7, 1)), (2, day(7)), (1, day(7, 1))])
    joined = historical_features(store, requests, ["firmware", "load"])
    found = rows_of(joined.orderBy("row_id"), "firmware", "load")
    assert found == [(2.5, 7.0), (None, None), (2.5, 7.0)]
    only = historical_features(store, requests, ["load"])
    plan = only._jdf.queryExecution().executedPlan().toString()
    assert "snapshot_date" in plan.split("PartitionFilters: [")[1].split("]")[0]
    read = {file.split("snapshot_date=")[1][:10] for file in only.inputFiles()}
    assert read == {"2026-03-05", "2026-03-06", "2026-03-07"}


def test_unknown_feature_raises(store):
    with pytest.raises(NotRegisteredError):
        historical_features(store, request_rows(store.spark, []), ["typo"])


def test_hot_keys_and_lookup_join(spark):
    rows = spark.createDataFrame([(n, 1 if n % 3 else n) for n in range(60)], "id int, key int")
    rows = rows.unionByName(spark.createDataFrame([(100, None)], "id int, key int"))
    table = spark.createDataFrame([(1, "one"), (3, "three")], "key int, name string")
    assert rows_of(hot_keys(rows, ["key"], 10), "key", "n_rows") == [(1, 40)]
    split = lookup_join(rows, table, ["key"], hot_rows=10)
    plain = lookup_join(rows, table, ["key"], hot_rows=None)
    assert split.columns == plain.columns == ["id", "key", "name"]
    assert sorted(rows_of(split), key=str) == sorted(rows_of(plain), key=str)
    assert split.count() == 61


@pytest.mark.parametrize("slices", [1, 9])
def test_running_totals(spark, slices):
    rng = random.Random(1)
    data = [(rng.choice("ab"), n, rng.randrange(10)) for n in rng.sample(range(500), 100)]
    frame = cut(spark.createDataFrame(data, "g string, x int, n int"))
    found = running_totals(frame, ["g"], "x", {"upto": "n"}, slices)
    for g, x, n, upto in rows_of(found, "g", "x", "n", "upto"):
        assert upto == sum(c for a, b, c in data if a == g and b <= x)
    assert found.count() == 100


@pytest.mark.parametrize("hot_rows", [None, 3])
def test_wide_values_answer_like_long_ones(spark, hot_rows):
    """A wide row stores every feature at its moment, also as null, and travels as one row."""
    rng = random.Random(5)
    stored = {
        (machine, day(4) + n * HOUR): [rng.choice([None, float("nan"), 1.0, 2.5]) for _ in TTLS]
        for machine in (1, 2)
        for n in rng.sample(range(60), 12)
    }
    long = [
        (name, machine, at, value)
        for (machine, at), values in stored.items()
        for name, value in zip(TTLS, values, strict=True)
    ]
    columns = ", ".join(f"{name} double" for name in TTLS)
    wide = spark.createDataFrame(
        [(*key, *values) for key, values in stored.items()],
        f"entity_id bigint, event_timestamp timestamp, {columns}",
    )
    requests = request_rows(
        spark, [(machine, day(4) + n * HOUR) for machine in (1, 2, 3) for n in range(0, 90, 2)]
    )
    answers = [
        [tuple(map(str, row)) for row in rows_of(joined.orderBy("row_id"), "row_id", *TTLS)]
        for joined in (
            asof_join(requests, long_values(spark, long), TTLS, hot_rows=hot_rows),
            asof_join(requests, wide, TTLS, hot_rows=hot_rows),
        )
    ]
    assert answers[0] == answers[1]
