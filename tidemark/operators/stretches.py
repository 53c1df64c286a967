"""Counts of doubles by their leading bits, added up inside tasks.

A stretch is all doubles whose sign, exponent and first twelve binary places agree. Stretches are in
the order of their values, so ranks found among stretches say which of them hold a value in demand.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The places of a double that tell the values of a stretch apart.
PLACES = 40
# Values that are sorted at once, and stretches of a feature that a task holds.
HELD_VALUES = 1 << 19
HELD_STRETCHES = 1 << 20

_COUNTED = "feature int, stretch bigint, value double, n bigint"
_TYPES = pa.schema(
    [("feature", pa.int32()), ("stretch", pa.int64()), ("value", pa.float64()), ("n", pa.int64())]
)


def counts_by_stretch(wide: DataFrame, features: Sequence[str]) -> DataFrame:
    """`feature_name, stretch, value, n`: rows per stretch, with the largest value in it.

    Nulls and NaN are left out.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [_nothing() for _ in features]
        for found in _pieces(batches, len(features)):
            for feature, values in enumerate(found):
                held[feature] = _together(held[feature], _counted(values, by_stretch=True))
                if len(held[feature][0]) > HELD_STRETCHES:
                    yield _rows(feature, held[feature])
                    held[feature] = _nothing()
        for feature, own in enumerate(held):
            yield _rows(feature, own)

    return (
        _named(_doubles(wide, features).mapInArrow(counted, _COUNTED), features)
        .groupBy("feature_name", "stretch")
        .agg(F.max("value").alias("value"), F.sum("n").alias("n"))
    )


def counts_by_value(
    wide: DataFrame, features: Sequence[str], wanted: Mapping[str, Sequence[int]]
) -> DataFrame:
    """`feature_name, value, n`: rows per distinct value of the wanted stretches of each feature."""
    kept = [np.array(sorted(wanted.get(name, ())), dtype=np.int64) for name in features]

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found in _pieces(batches, len(features), kept):
            for feature, values in enumerate(found):
                yield _rows(feature, _counted(values, by_stretch=False))

    return (
        _named(_doubles(wide, features).mapInArrow(counted, _COUNTED), features)
        .groupBy("feature_name", "value")
        .agg(F.sum("n").alias("n"))
    )


def _doubles(wide: DataFrame, features: Sequence[str]) -> DataFrame:
    return wide.select(*[F.col(name).cast("double").alias(f"_{n}") for n, name in enumerate(features)])


def _named(counted: DataFrame, features: Sequence[str]) -> DataFrame:
    names = F.array(*[F.lit(name) for name in features])
    return counted.withColumn("feature_name", F.get(names, F.col("feature")))


def _stretch(values: np.ndarray) -> np.ndarray:
    """The number of the stretch of each value; -0.0 is in that of 0.0."""
    bits = (values + 0.0).view(np.int64)
    return (bits ^ ((bits >> 63) & np.int64(2**63 - 1))) >> PLACES


def _pieces(
    batches: Iterator[pa.RecordBatch], n_features: int, kept: Sequence[np.ndarray] | None = None
) -> Iterator[list[np.ndarray]]:
    """The present values per feature, of several batches at once; of the stretches kept if given."""
    held: list[list[np.ndarray]] = [[] for _ in range(n_features)]
    size = 0
    for batch in batches:
        for feature, column in enumerate(batch.columns):
            values = column.to_numpy(zero_copy_only=False)
            values = values[~np.isnan(values)]
            if kept is not None:
                values = values[np.isin(_stretch(values), kept[feature])]
            held[feature].append(values)
        size = max(sum(map(len, own)) for own in held)
        if size >= HELD_VALUES:
            yield [np.concatenate(own) for own in held]
            held, size = [[] for _ in range(n_features)], 0
    if size:
        yield [np.concatenate(own) for own in held]


def _nothing():
    return np.empty(0, np.int64), np.empty(0), np.empty(0, np.int64)


def _counted(values: np.ndarray, by_stretch: bool):
    """Stretch, largest value and rows, per stretch or distinct value."""
    if not len(values):
        return _nothing()
    values = np.sort(values + 0.0)
    stretch = _stretch(values)
    key = stretch if by_stretch else values
    last = np.flatnonzero(np.append(key[1:] != key[:-1], True))
    return stretch[last], values[last], np.diff(last, prepend=-1)


def _together(one, other):
    """Counts per stretch of both."""
    stretch, value, n = (np.concatenate(pair) for pair in zip(one, other, strict=True))
    if not len(stretch):
        return one
    order = np.argsort(stretch, kind="stable")
    stretch, value, n = stretch[order], value[order], n[order]
    first = np.flatnonzero(np.append(True, stretch[1:] != stretch[:-1]))
    return stretch[first], np.maximum.reduceat(value, first), np.add.reduceat(n, first)


def _rows(feature: int, counted) -> pa.RecordBatch:
    stretch, value, n = counted
    number = np.full(len(stretch), feature, np.int32)
    return pa.RecordBatch.from_arrays([pa.array(x) for x in (number, stretch, value, n)], schema=_TYPES)
