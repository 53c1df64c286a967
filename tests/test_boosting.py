"""Boosted trees against the same trees grown by hand, and gaps that say something."""

import math
import random

import pytest
from conftest import rows_of

from tidemark.plans import boosting
from tidemark.plans.boosting import BoostedTrees, _binned, _cells, fit_boosted_trees
from tidemark.plans.modeling import measured_auc, score

PENALTY, RATE, LEAST = 1.0, 0.1, 3


def rows(seed, n=90):
    rng = random.Random(seed)
    found = []
    for _ in range(n):
        a, b = rng.randrange(6), rng.choice([None, float("nan"), 0.5, 1.5, 2.5, 2.5])
        known = b is not None and b == b
        chance = 0.1 + 0.12 * a + (0.0 if known else 0.25)
        found.append((float(a), b, int(rng.random() < chance)))
    return found


def by_hand(data, trees, depth):
    """Every split between distinct values, missing ones on either side, tried row by row."""
    clean = [tuple(None if v is None or v != v else v for v in row[:2]) for row in data]
    labels = [row[2] for row in data]
    share = sum(labels) / len(labels)
    raw = [math.log(share / (1 - share))] * len(data)

    def sums(members):
        chances = [1 / (1 + math.exp(-raw[i])) for i in members]
        gradient = sum(p - labels[i] for p, i in zip(chances, members, strict=True))
        return gradient, sum(p * (1 - p) for p in chances)

    def worth(members):
        gradient, curvature = sums(members)
        return gradient**2 / (curvature + PENALTY)

    def grow(members, left_depth, added):
        best, found = 1e-9, None
        for feature in (0, 1):
            values = sorted({clean[i][feature] for i in members} - {None})
            for missing_left in (False, True):
                for edge in values:
                    left = [i for i in members if
                            (missing_left if clean[i][feature] is None else clean[i][feature] <= edge)]
                    right = [i for i in members if i not in set(left)]
                    if min(len(left), len(right)) < LEAST:
                        continue
                    gain = worth(left) + worth(right) - worth(members)
                    if gain > best + 1e-9:
                        best, found = gain, (left, right)
        if left_depth == 0 or found is None:
            gradient, curvature = sums(members)
            for i in members:
                added[i] = -RATE * gradient / (curvature + PENALTY)
            return
        for side in found:
            grow(side, left_depth - 1, added)

    for _ in range(trees):
        added = {}
        grow(list(range(len(data))), depth, added)
        raw = [value + added[i] for i, value in enumerate(raw)]
    return [1 / (1 + math.exp(-value)) for value in raw]


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_trees_grown_by_hand(spark, seed):
    data = rows(seed)
    frame = spark.createDataFrame(
        [(n, *row) for n, row in enumerate(data)], "n int, a double, b double, label int"
    )
    model = fit_boosted_trees(frame, ["a", "b"], 4, 2, RATE, 1000, PENALTY, LEAST)
    found = [r[0] for r in rows_of(score(model, frame).orderBy("n"), "score")]
    assert found == pytest.approx(by_hand(data, 4, 2), abs=1e-9)
    again = BoostedTrees.from_json(model.to_json())
    assert again == model


def test_scores_written_between_trees(spark, monkeypatch):
    """Trees that are already in the written scores and trees that are not count once each."""
    monkeypatch.setattr(boosting, "TREES_A_PLAN", 2)
    data = rows(3)
    frame = spark.createDataFrame(
        [(n, *row) for n, row in enumerate(data)], "n int, a double, b double, label int"
    )
    model = fit_boosted_trees(frame, ["a", "b"], 5, 2, RATE, 1000, PENALTY, LEAST)
    found = [r[0] for r in rows_of(score(model, frame).orderBy("n"), "score")]
    assert found == pytest.approx(by_hand(data, 5, 2), abs=1e-9)


def test_gaps_that_say_something(spark):
    """Buyers leave the value out; filled in with the middle value, they look like the others."""
    rng = random.Random(5)
    data = []
    for n in range(600):
        label = int(rng.random() < 0.4)
        missing = rng.random() < (0.7 if label else 0.1)
        data.append((n, None if missing else rng.gauss(5, 1), label))
    frame = spark.createDataFrame(data, "n int, a double, label int").repartition(3)
    aware = measured_auc(score(fit_boosted_trees(frame, ["a"], 5), frame))
    filled = frame.fillna(5.0, ["a"])
    unaware = measured_auc(score(fit_boosted_trees(filled, ["a"], 5), filled))
    assert aware > 0.75
    assert aware > unaware
    assert measured_auc(score(fit_boosted_trees(filled, ["a"], 5), frame)) < aware


def test_what_cannot_be_learned(spark):
    alike = spark.createDataFrame([(1.0, 1)] * 50, "a double, label int")
    model = fit_boosted_trees(alike, ["a"], 2)
    assert [r[0] for r in rows_of(score(model, alike), "score")] == pytest.approx([1.0] * 50, abs=1e-3)
    gaps = spark.createDataFrame([(None, n % 2) for n in range(50)], "a double, label int")
    model = fit_boosted_trees(gaps, ["a"], 2)
    assert {r[0] for r in rows_of(score(model, gaps), "score")} == {0.5}
    with pytest.raises(ValueError, match="no rows"):
        fit_boosted_trees(alike.limit(0), ["a"], 1)


def test_rows_with_equal_bins_are_one_cell(spark):
    """Trees are grown over counted cells: copies of rows add counts and no rows."""
    data = rows(4) * 7 + [(1.0, None, None)]
    frame = spark.createDataFrame(data, "a double, b double, label int")
    edges = {"a": [0.5, 1.5, 2.5], "b": [1.0, 2.0]}
    found = rows_of(_cells(_binned(frame, edges, 5)))
    expected = {}
    for a, b, label in data:
        missing = b is None or b != b
        bins = (sum(e < a for e in edges["a"]), 4 if missing else sum(e < b for e in edges["b"]))
        n, labelled, positives = expected.get(bins, (0, 0, 0.0))
        known = label is not None
        expected[bins] = (n + 1, labelled + known, positives + (label or 0))
    assert {tuple(bins): tuple(counts) for bins, *counts in found} == expected
    assert len(found) == len(expected)
