"""Gradient-boosted trees over binned values, with missing values routed by what they are worth.

Values are put into bins between exact quantiles once. Rows that agree in all bins have the same
score whatever the trees, so they are counted and become one row with their labels added up: the
trees are grown over the cells that hold any row. A level of a tree is one aggregation: the sums of
gradients and curvatures per node, feature and bin, a few thousand numbers whatever the number of
rows, from which the best split of every node follows. Missing values have a bin of their own, and
each split tries them on both sides, so a gap that says something is not filled in.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.drift import deciding_counts, quantile_edges
from tidemark.session import cut, discard

BINS = 64
DEPTH = 3
RATE = 0.1
# What is added to the curvature of a leaf, and the rows it has at least.
PENALTY = 1.0
LEAST_ROWS = 20
# Trees after which the scores so far are written, so that no task takes more of them anew.
TREES_A_PLAN = 10


@dataclass(frozen=True)
class BoostedTrees:
    """`score` as the log odds `base` plus the leaves of all trees.

    A tree is a leaf's number, or (feature, edge, missing goes left, left tree, right tree); values
    up to the edge go left.
    """

    features: tuple[str, ...]
    base: float
    trees: tuple

    def log_odds(self) -> Column:
        return _log_odds(self)(*[F.col(name).cast("double") for name in self.features])

    def probability(self) -> Column:
        return 1 / (1 + F.exp(-self.log_odds()))

    def to_json(self) -> str:
        return json.dumps({"features": self.features, "base": self.base, "trees": self.trees})

    @classmethod
    def from_json(cls, text: str) -> BoostedTrees:
        found = json.loads(text)

        def tree(node):
            return (*node[:3], tree(node[3]), tree(node[4])) if isinstance(node, list) else node

        return cls(tuple(found["features"]), found["base"], tuple(map(tree, found["trees"])))


def _log_odds(model: BoostedTrees):
    """All trees over many rows at once; one expression of twenty trees took several times as long."""
    places = {name: place for place, name in enumerate(model.features)}
    base, trees = model.base, model.trees

    @F.arrow_udf("double")
    def added_up(*columns: pa.Array) -> pa.Array:
        values = [column.to_numpy(zero_copy_only=False) for column in columns]
        missing = [np.isnan(own) for own in values]

        def leaf(tree):
            if not isinstance(tree, tuple):
                return tree
            feature, edge, missing_left, left, right = tree
            place = places[feature]
            goes_left = values[place] <= edge
            if missing_left:
                goes_left |= missing[place]
            return np.where(goes_left, leaf(left), leaf(right))

        total = np.full(len(values[0]), base)
        for tree in trees:
            total += leaf(tree)
        return pa.array(total, pa.float64())

    return added_up


@dataclass(frozen=True)
class _Split:
    feature: int
    last_left: int
    missing_left: bool
    sides: tuple[tuple[float, float], tuple[float, float]]


def best_split(sums: np.ndarray, penalty: float, least_rows: int) -> _Split | None:
    """The split with the greatest gain of one node; of equal ones the first.

    `sums[feature, bin]` holds gradient, curvature and rows; the last bin is that of missing values.
    """
    whole = sums[0].sum(axis=0)
    parent = whole[0] ** 2 / (whole[1] + penalty)
    best, found = 1e-12, None
    for feature, own in enumerate(sums):
        present, missing = np.cumsum(own[:-1], axis=0), own[-1]
        for missing_left in (False, True):
            left = present + missing if missing_left else present
            right = whole - left
            allowed = (left[:, 2] >= least_rows) & (right[:, 2] >= least_rows)
            gain = (
                left[:, 0] ** 2 / (left[:, 1] + penalty)
                + right[:, 0] ** 2 / (right[:, 1] + penalty)
                - parent
            )
            gain = np.where(allowed, gain, -np.inf)
            place = int(np.argmax(gain))
            if gain[place] > best + 1e-9 * abs(best):
                best = gain[place]
                sides = tuple((float(s[0]), float(s[1])) for s in (left[place], right[place]))
                found = _Split(feature, place, missing_left, sides)
    return found


def fit_boosted_trees(
    train: DataFrame,
    features: Sequence[str],
    trees: int = 100,
    depth: int = DEPTH,
    rate: float = RATE,
    bins: int = BINS,
    penalty: float = PENALTY,
    least_rows: int = LEAST_ROWS,
    counts: DataFrame | None = None,
) -> BoostedTrees:
    """Trees for the log loss of `label` (0 or 1), each fitted to what the others leave over.

    `counts`: `deciding_counts` of the rows for these bins or a multiple, if they are there already.
    """
    counts = deciding_counts(train, features, bins) if counts is None else counts
    edges = {row["feature_name"]: row["edges"] for row in quantile_edges(counts, bins).collect()}
    edges = {name: [float(edge) for edge in edges.get(name, [])] for name in features}
    size = max(map(len, edges.values())) + 2
    frame = cut(_cells(_binned(train, edges, size)))
    share = frame.agg(F.try_divide(F.sum("positives"), F.sum("labelled"))).first()[0]
    if share is None:
        raise ValueError("no rows to learn from")
    share = min(max(share, 1e-6), 1 - 1e-6)
    base = float(np.log(share / (1 - share)))
    scored = frame.withColumn("raw", F.lit(base))
    written, found, unwritten = [frame], [], []
    for number in range(trees):
        tree = _fit_tree(scored, unwritten, len(features), size, depth, rate, penalty, least_rows)
        found.append(tree)
        unwritten.append(tree)
        if number % TREES_A_PLAN == TREES_A_PLAN - 1 and number < trees - 1:
            scored, unwritten = cut(_with_trees(scored, unwritten, len(features), size)), []
            written.append(scored)
    discard(*written)
    names = list(features)
    return BoostedTrees(tuple(names), base, tuple(_named(tree, names, edges) for tree in found))


def _binned(train: DataFrame, edges: Mapping[str, list[float]], size: int) -> DataFrame:
    """`label` and one bin number per feature; missing values in the last bin."""
    numbers = [_bin_of(own, size - 1)(F.col(name).cast("double")) for name, own in edges.items()]
    return train.select(F.col("label").cast("double").alias("label"), F.array(*numbers).alias("bins"))


def _bin_of(edges: list[float], missing: int):
    """The number of edges below a value, by binary search; `missing` for null and NaN."""
    limits = np.array(edges, dtype=float)

    @F.arrow_udf("int")
    def number(values: pa.Array) -> pa.Array:
        found = values.to_numpy(zero_copy_only=False)
        below = np.searchsorted(limits, found, side="left")
        return pa.array(np.where(np.isnan(found), missing, below), pa.int32())

    return number


def _cells(binned: DataFrame) -> DataFrame:
    """`bins`, the rows that have them, the labels known of these and their sum."""
    return binned.groupBy("bins").agg(
        F.count(F.lit(1)).alias("n"),
        F.count("label").alias("labelled"),
        F.coalesce(F.sum("label"), F.lit(0.0)).alias("positives"),
    )


def _fit_tree(scored, unwritten, n_features, size, depth, rate, penalty, least_rows):
    """A tree over bins, level by level: one aggregation for all nodes of a level.

    `unwritten`: the trees that are not yet in the scores.
    """
    splits: dict[int, _Split] = {}
    open_nodes = [1]
    for _ in range(depth):
        sums = _sums(scored, unwritten, splits, open_nodes, n_features, size)
        following = []
        for node in open_nodes:
            split = best_split(sums[node], penalty, least_rows) if node in sums else None
            if split is not None:
                splits[node] = split
                following += [2 * node, 2 * node + 1]
        if not following:
            break
        open_nodes = following

    def tree(node: int, totals: tuple[float, float]):
        if node not in splits:
            return float(-rate * totals[0] / (totals[1] + penalty))
        split = splits[node]
        left, right = (tree(2 * node + side, split.sides[side]) for side in (0, 1))
        return split.feature, split.last_left, split.missing_left, left, right

    if 1 not in splits:
        return 0.0
    return tree(1, (0.0, 0.0))


def _goes_left(bins: np.ndarray, feature: int, last_left: int, missing_left: bool, size: int):
    number = bins[:, feature]
    return np.where(number == size - 1, missing_left, number <= last_left)


def _by_bins(tree, bins: np.ndarray, size: int):
    """The leaf of each cell."""
    if not isinstance(tree, tuple):
        return tree
    feature, last_left, missing_left, left, right = tree
    goes_left = _goes_left(bins, feature, last_left, missing_left, size)
    return np.where(goes_left, _by_bins(left, bins, size), _by_bins(right, bins, size))


def _node_of(splits: Mapping[int, _Split], bins: np.ndarray, size: int) -> np.ndarray:
    """The node each cell has come to."""
    node = np.ones(len(bins), dtype=np.int64)
    for number, split in sorted(splits.items()):
        own = node == number
        left = _goes_left(bins[own], split.feature, split.last_left, split.missing_left, size)
        node[own] = 2 * number + ~left
    return node


def _read(batch: pa.RecordBatch, trees: Sequence, n_features: int, size: int):
    """Bins, and scores with some more trees."""
    bins = batch.column("bins").flatten().to_numpy().reshape(-1, n_features)
    raw = batch.column("raw").to_numpy()
    for tree in trees:
        raw = raw + _by_bins(tree, bins, size)
    return bins, raw


def _with_trees(scored: DataFrame, trees: Sequence, n_features: int, size: int) -> DataFrame:
    """The cells with scores that hold some more trees."""
    place = scored.columns.index("raw")

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, raw = _read(batch, trees, n_features, size)
            yield batch.set_column(place, "raw", pa.array(raw, pa.float64()))

    return scored.mapInArrow(added, scored.schema)


def _sums(scored, unwritten, splits, open_nodes, n_features, size) -> dict[int, np.ndarray]:
    """Per open node: gradient, curvature and rows of each feature and bin.

    Every task adds its cells up and returns one small table of sums.
    """
    nodes, shape = np.array(open_nodes), (len(open_nodes), n_features, size, 3)

    def added_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        for batch in batches:
            bins, raw = _read(batch, unwritten, n_features, size)
            node = _node_of(splits, bins, size)
            slot = np.minimum(np.searchsorted(nodes, node), len(nodes) - 1)
            own = nodes[slot] == node
            chance = 1 / (1 + np.exp(-raw[own]))
            n, labelled, positives = (
                batch.column(name).to_numpy()[own] for name in ("n", "labelled", "positives")
            )
            weights = chance * labelled - positives, chance * (1 - chance) * n, n
            cell = (slot[own, None] * n_features + np.arange(n_features)) * size + bins[own]
            for number, weight in enumerate(weights):
                total[..., number] += np.bincount(
                    cell.ravel(), np.repeat(weight, n_features), total[..., number].size
                ).reshape(shape[:-1])
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["sums"])

    columns = scored.select("bins", "n", "labelled", "positives", "raw")
    total = np.zeros(shape)
    for row in columns.mapInArrow(added_up, "sums binary").collect():
        total += np.frombuffer(row["sums"]).reshape(shape)
    return {node: own for node, own in zip(open_nodes, total, strict=True) if own[..., 2].any()}


def _named(tree, names: list[str], edges: Mapping[str, list[float]]):
    """The same tree over values: a bin ends at its edge, the last one nowhere."""
    if not isinstance(tree, tuple):
        return tree
    feature, last_left, missing_left, left, right = tree
    own = edges[names[feature]]
    edge = own[last_left] if last_left < len(own) else float("inf")
    left, right = (_named(side, names, edges) for side in (left, right))
    return names[feature], edge, missing_left, left, right

