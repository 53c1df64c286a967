"""What tasks do with scores that hardly ever repeat: combine equal ones, and measure slices of them."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

# Rows whose scores are sorted at once.
HELD_ROWS = 1 << 18

COMBINED = "group int, score double, positives bigint, negatives bigint"


def combined_scores(n_scores: int):
    """A function of batches of `part`, `label` (1, 0 or another) and columns of scores.

    It gives rows of `group` (number of the part times the columns, plus the column) and `score` with
    `positives` and `negatives`, equal ones of many rows added up.
    """

    def combined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= HELD_ROWS:
                yield from _combined(held, n_scores)
                held, size = [], 0
        if size:
            yield from _combined(held, n_scores)

    return combined


def slice_of(bounds: Sequence[float]):
    """The number of bounds below a score."""
    limits = np.unique(np.array(bounds, dtype=float))

    @F.arrow_udf("int")
    def number(scores: pa.Array) -> pa.Array:
        found = scores.to_numpy(zero_copy_only=False)
        return pa.array(np.searchsorted(limits, found, side="left"), pa.int32())

    return number


def measured_slices(
    below: Mapping[tuple[int, int], tuple[int, int]],
    totals: Mapping[int, tuple[int, int]],
    wanted_recall: float,
):
    """A function of batches in the order of `group`, `slice`, `score` that measures each slice.

    `below` has the positives and negatives of a group's earlier slices, `totals` those of all. A
    slice gives the pairs its positives win, ties counting half, and the best precision of its
    cut-offs that reach the recall.
    """

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slices: dict[int, list] = {}
        at = None
        for batch in batches:
            group, score, positives, negatives, number = _columns(
                batch, ["group", "score", "positives", "negatives", "slice"]
            )
            changes = (group[1:] != group[:-1]) | (number[1:] != number[:-1])
            starts = [0, *(np.flatnonzero(changes) + 1).tolist(), len(group)]
            for first, end in zip(starts, starts[1:], strict=False):
                if first == end:
                    continue
                key = int(group[first]), int(number[first])
                if at is None or at.key != key:
                    if at is not None:
                        slices.setdefault(at.key[0], []).append(at.ended())
                    at = _Slice(key, below[key], totals[key[0]], wanted_recall)
                at.add(score[first:end], positives[first:end], negatives[first:end])
        if at is not None:
            slices.setdefault(at.key[0], []).append(at.ended())
        rows = [(group, *own) for group, each in slices.items() for own in each]
        columns = list(zip(*rows, strict=True)) or [(), (), ()]
        kinds = (pa.int32(), pa.float64(), pa.float64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(own, kind) for own, kind in zip(columns, kinds, strict=True)],
            ["group", "area", "precision"],
        )

    return measured


class _Slice:
    """A slice that comes in pieces; the last score waits, as the next piece may go on with it."""

    def __init__(self, key, below, totals, wanted_recall):
        self.key, self.below, self.totals = key, below, totals
        self.wanted_recall = wanted_recall
        self.waiting = np.empty(0), np.empty(0, np.int64), np.empty(0, np.int64)
        self.area, self.precision = 0.0, None

    def add(self, *piece: np.ndarray) -> None:
        together = [np.concatenate(pair) for pair in zip(self.waiting, piece, strict=True)]
        score, positives, negatives = _per_score(*together)
        self.waiting = score[-1:], positives[-1:], negatives[-1:]
        self._measure(positives[:-1], negatives[:-1])

    def ended(self) -> tuple[float, float | None]:
        self._measure(*self.waiting[1:])
        return self.area, self.precision

    def _measure(self, positives: np.ndarray, negatives: np.ndarray) -> None:
        if not len(positives):
            return
        positives_below = self.below[0] + np.cumsum(positives) - positives
        negatives_below = self.below[1] + np.cumsum(negatives) - negatives
        self.below = positives_below[-1] + positives[-1], negatives_below[-1] + negatives[-1]
        self.area += float(np.sum(positives * (negatives_below + negatives / 2)))
        hits, misses = self.totals[0] - positives_below, self.totals[1] - negatives_below
        reached = hits + misses > 0
        if self.totals[0]:
            reached &= hits / self.totals[0] >= self.wanted_recall
        else:
            reached[:] = False
        if reached.any():
            best = float(np.max(hits[reached] / (hits + misses)[reached]))
            self.precision = best if self.precision is None else max(best, self.precision)


def _columns(batch: pa.RecordBatch, names: Sequence[str]) -> list[np.ndarray]:
    return [batch.column(name).to_numpy(zero_copy_only=False) for name in names]


def _per_score(score: np.ndarray, positives: np.ndarray, negatives: np.ndarray):
    """Sorted scores, equal ones added up; NaN is equal to itself."""
    differ = (score[1:] != score[:-1]) & ~(np.isnan(score[1:]) & np.isnan(score[:-1]))
    first = np.flatnonzero(np.append(True, differ))
    return score[first], np.add.reduceat(positives, first), np.add.reduceat(negatives, first)


def _combined(held: Sequence[pa.RecordBatch], n_scores: int) -> Iterator[pa.RecordBatch]:
    names = ["part", "label", *[f"_{n}" for n in range(n_scores)]]
    parts, labels, *scores = (
        np.concatenate(own) for own in zip(*(_columns(batch, names) for batch in held), strict=True)
    )
    for part in np.unique(parts):
        own = parts == part
        label = labels[own]
        for n, each in enumerate(scores):
            score = each[own] + 0.0
            order = np.argsort(score)
            known = label[order]
            found = _per_score(
                score[order], (known == 1).astype(np.int64), (known == 0).astype(np.int64)
            )
            group = np.full(len(found[0]), part * n_scores + n, np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (group, *found)], ["group", "score", "positives", "negatives"]
            )
