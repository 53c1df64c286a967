"""Words of whole texts as arrays, inside tasks.

A word is a run of bytes other than space, tab, newline, vertical tab, form feed and carriage
return. Texts are handled as UTF-8, a slice of documents at a time, so that a task holds a bounded
amount of text besides the document it is at.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterable, Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SLICE_BYTES = 8 << 20
BATCH_ROWS = 1_000
KEPT_BYTES = 64 << 20
# Parameters of the C library, from its malloc.h
M_TRIM_THRESHOLD, M_MMAP_THRESHOLD = -1, -3
# Words of more bytes are digested one by one.
LONG_WORD = 128

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
SOLID = (~SPACE).tobytes()
FIRST_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def documents(frame: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id and the text, the text as UTF-8 bytes and null as empty.

    No other column of the caller goes on, so none can clash with what an operator adds.
    """
    few_rows_a_batch(frame.sparkSession)
    return frame.select(F.col(id_col).alias("doc_id"), utf8(F.col(text_col)).alias("text"))


def utf8(text: Column) -> Column:
    return F.coalesce(text, F.lit("")).cast("binary")


def quoted(name: str) -> str:
    """The name of a column as Spark reads it, dots and all."""
    return "`" + name.replace("`", "``") + "`"


def few_rows_a_batch(spark: SparkSession) -> None:
    """Bounds the text that goes to Python at once."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def slices(batches: Iterable[pa.RecordBatch], most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most `most` bytes of text, or of one row.

    After the last one the memory that is free goes back, as the worker may wait for its next task.
    """
    for batch in batches:
        yield from parts(batch, most)
    give_back()


def parts(batch: pa.RecordBatch, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The slices of one batch."""
    ends = np.cumsum(pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False))
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + most, "right")))
        yield batch.slice(start, stop - start)
        start = stop


def keep_freed() -> None:
    """Up to KEPT_BYTES of freed memory stay with the worker until `give_back`. Work on many arrays
    of some 100 KB otherwise takes its pages from the system and returns them over and over."""
    mallopt = getattr(ctypes.CDLL(None), "mallopt", None)
    if mallopt is not None:
        mallopt(M_TRIM_THRESHOLD, KEPT_BYTES)
        mallopt(M_MMAP_THRESHOLD, KEPT_BYTES // 2)


def give_back() -> None:
    """Returns freed memory to the system, which other workers of the executor need."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


class Words:
    """The words of several texts, one after the other.

    `joined`: the texts with a line break behind each; `offsets`: their places there, and the end;
    `starts`, `ends`: places of the words; `first`: number of each text's first word, and the end.
    """

    def __init__(self, texts: list[bytes], lower: bool = False):
        joined = b"\n".join([*texts, b""])
        self.joined = joined.lower() if lower else joined
        self.data = np.frombuffer(self.joined, np.uint8)
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        self.offsets = np.concatenate([[0], np.cumsum(lengths + 1)])
        self.solid = np.frombuffer(self.joined.translate(SOLID), bool)
        self.edges = np.flatnonzero(np.diff(self.solid, prepend=False, append=False))
        self.starts, self.ends = self.edges[::2], self.edges[1::2]
        self.first = np.searchsorted(self.starts, self.offsets)

    def __len__(self) -> int:
        return len(self.starts)

    def word(self, place: int) -> bytes:
        return self.joined[self.starts[place] : self.ends[place]]

    def words(self, places: np.ndarray) -> list[bytes]:
        starts, ends = self.starts[places].tolist(), self.ends[places].tolist()
        return [self.joined[start:end] for start, end in zip(starts, ends, strict=True)]

    def array(self, places: np.ndarray) -> pa.Array:
        """The same as Arrow has them. What lies between two edges is a word at every other one."""
        if not len(places):
            return pa.array([], pa.binary())
        edges = pa.py_buffer(self.edges.astype(np.int32))
        whole = [None, edges, pa.py_buffer(self.joined)]
        between = pa.Array.from_buffers(pa.binary(), len(self.edges) - 1, whole)
        return between.take(pa.array(2 * places))

    @property
    def counts(self) -> np.ndarray:
        """Words of each text."""
        return np.diff(self.first)

    @property
    def text(self) -> np.ndarray:
        """For each word the number of its text."""
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def per_text(self, flags: np.ndarray) -> np.ndarray:
        """How many bytes of each text have the flag."""
        return _sums(flags, self.offsets)

    def per_words(self, values: np.ndarray) -> np.ndarray:
        """Sum over the words of each text."""
        return _sums(values, self.first)

    def hashes(self) -> np.ndarray:
        """A 64-bit digest of each word, the same in every task."""
        lengths = self.ends - self.starts
        found = lengths.astype(np.uint64)
        # Eight bytes from each place on, as a view
        padded = np.concatenate([self.data, np.zeros(8, np.uint8)])
        eights = np.lib.stride_tricks.as_strided(padded, (len(self.data) + 1, 8), (1, 1))
        todo, done = np.flatnonzero(lengths <= LONG_WORD), 0
        while len(todo):
            left = lengths[todo] - done
            part = eights[self.starts[todo] + done].view("<u8")[:, 0]
            part &= FIRST_BYTES[np.minimum(left, 8)]
            found[todo] = mixed(found[todo], part)
            todo, done = todo[left > 8], done + 8
        for place in np.flatnonzero(lengths > LONG_WORD):
            digest = blake2b(self.word(place), digest_size=8).digest()
            found[place] = int.from_bytes(digest, "little")
        return found


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[bounds[1:]] - total[bounds[:-1]]


def mixed(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """A 64-bit digest of each ordered pair of digests."""
    x = (left ^ (left >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) + right
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Digest of the `size` words from each place on; shorter by size - 1 than `words`."""
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    power, width, found, done = words, 1, None, 0
    while True:
        if size & width:
            part = power[done : done + n]
            found = part if found is None else mixed(found, part)
            done += width
        if done == size:
            return found
        power, width = mixed(power[:-width], power[width:]), 2 * width


def in_one_text(words: Words, size: int) -> np.ndarray:
    """Places whose next `size` words all belong to the same text, in ascending order."""
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, np.int64)
    ends = np.repeat(words.first[1:], words.counts)[:n]
    return np.flatnonzero(np.arange(n) + size <= ends)
