"""Many small records dealt out by a digest, as packed arrays.

A task packs its records into one row per bucket, with an array per column, instead of a row per
record. Spark shuffles and groups these rows by bucket; the group unpacks them into arrays again.
The number of buckets follows the number of shuffle partitions, and a group holds one bucket: more
data need more shuffle partitions.

An array is packed by planes, the lowest bytes of all its numbers first: ids, sizes and places differ
in their low bytes only, so most planes are nearly constant and the shuffle compresses them away.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession

BUCKETS_PER_PARTITION = 2


def bucket_count(spark: SparkSession, per_partition: int = BUCKETS_PER_PARTITION) -> int:
    return per_partition * int(spark.conf.get("spark.sql.shuffle.partitions"))


def bucket_of(digests: np.ndarray, n_buckets: int) -> np.ndarray:
    """The bucket of each digest, by its high half."""
    return ((digests >> np.uint64(32)) * np.uint64(n_buckets) >> np.uint64(32)).astype(np.int32)


def schema(columns: dict[str, str]) -> str:
    return ", ".join(["bucket int", *[f"{name} binary" for name in columns]])


def pack(buckets: np.ndarray, columns: dict[str, np.ndarray]) -> pa.RecordBatch:
    """One row per bucket that occurs; the order of its records is kept."""
    order = np.argsort(buckets, kind="stable")
    found, first = np.unique(buckets[order], return_index=True)
    bounds = np.append(first, len(order))
    arrays = {"bucket": pa.array(found.astype(np.int32))}
    for name, values in columns.items():
        values = np.ascontiguousarray(values[order])
        offsets = (bounds * values.itemsize).astype(np.int32)
        data = _planes(values, np.diff(bounds))
        arrays[name] = pa.Array.from_buffers(
            pa.binary(), len(found), [None, pa.py_buffer(offsets), pa.py_buffer(data)]
        )
    return pa.RecordBatch.from_pydict(arrays)


def unpack(table: pa.Table, columns: dict[str, str]) -> dict[str, np.ndarray]:
    """All records of the rows; `columns` names the types of the arrays."""
    found = {}
    for name, kind in columns.items():
        parts = [np.empty(0, kind)]
        for chunk in table.column(name).chunks:
            if len(chunk):
                offsets = np.frombuffer(chunk.buffers()[1], np.int32)[
                    chunk.offset : chunk.offset + len(chunk) + 1
                ]
                size = offsets[-1] - offsets[0]
                if size:
                    data = np.frombuffer(chunk.buffers()[2], np.uint8, size, offsets[0])
                    parts.append(_numbers(data, np.diff(offsets), kind))
        found[name] = np.concatenate(parts)
    return found


def packed(values: np.ndarray) -> bytes:
    """What a row holds of one array."""
    return _planes(np.ascontiguousarray(values), np.array([len(values)])).tobytes()


def _planes(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The bytes of the rows' arrays, `counts` numbers each, one plane after the other."""
    size = values.itemsize
    data = values.view(np.uint8).reshape(len(values), size)
    if size == 1:
        return data.ravel()
    found = np.empty(data.size, np.uint8)
    at, step = _places(counts, size)
    for k in range(size):
        found[at] = data[:, k]
        at += step
    return found


def _numbers(data: np.ndarray, widths: np.ndarray, kind: str) -> np.ndarray:
    """The numbers of rows that take `widths` bytes each."""
    size = np.dtype(kind).itemsize
    if size == 1:
        return data.view(kind)
    found = np.empty((len(data) // size, size), np.uint8)
    at, step = _places(widths // size, size)
    for k in range(size):
        found[:, k] = data[at]
        at += step
    return found.view(kind).ravel()


def _places(counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Where the first byte of each number is, and how far its next one is from there."""
    counts = counts.astype(np.int64)
    before = np.cumsum(counts) - counts
    return np.repeat(before * (size - 1), counts) + np.arange(counts.sum()), np.repeat(counts, counts)


def groups(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and size of each run of equal keys in sorted keys."""
    if not len(keys):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    start = np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1])
    return start, np.diff(start, append=len(keys))
