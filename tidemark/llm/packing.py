"""Packing of encoded documents into training sequences, in one pass and bounded space.

Each partition keeps `open_windows` open windows. Of a document's ids, full windows are cut off
first; the rest goes where it fits best. If it fits nowhere, the fullest window is emitted; where
that would leave more than `max_gap` free places, the document fills them first and only its rest
looks for a window. What is still open at the end of a partition is merged: the pieces of a group of
partitions are laid end to end and cut into full windows, and the last few ids of a group become
sequences of powers of two, which need no padding.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.text import documents, few_rows_a_batch, slices
from tidemark.llm.vocabulary import BYTE_BPE, encoded_with_added, path
from tidemark.session import cut

WINDOW = 2048
OPEN_WINDOWS = 64
MAX_GAP = 8
MERGED_PARTITIONS = 64
# Fixed value: the id that ends a document.
END_ID = 1

PIECE = "doc_id bigint, start bigint, length bigint, doc_tokens bigint, sequence_id bigint, offset bigint, ids binary"
NAMES = [column.split()[0] for column in PIECE.split(", ")]


def packed(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary: str | None = None,
    window: int = WINDOW,
    open_windows: int = OPEN_WINDOWS,
    max_gap: int = MAX_GAP,
) -> DataFrame:
    """One row per piece: doc_id, start, length, doc_tokens, sequence_id, offset, ids.

    `start` is the piece's place among its document's ids and `offset` its place in the sequence;
    `ids` are little-endian unsigned 32-bit integers. Every row of `docs` gives the ids of its
    text (null: none) and one end id, each in exactly one piece; ids of documents are carried along
    only, so they may be null or repeat. Other columns are not read. An empty table has no pieces.
    Sequence ids are unique and tell the partition; they are the same when a task is repeated.
    """
    file = vocabulary or path(BYTE_BPE)
    rows = documents(docs, id_col, text_col)
    rows = rows.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")

    def placed(batches):
        number = TaskContext.get().partitionId()
        bins = Windows(number << 32, window, open_windows, max_gap)
        for batch in slices(batches):
            ids = batch.column("doc_id").to_pylist()
            for doc_id, text in zip(ids, batch.column("text").to_pylist(), strict=True):
                own = encoded_with_added(file, text.decode())
                own = np.append(own, np.uint32(END_ID)).astype("<u4")
                bins.add(doc_id, own)
            yield _batch(bins.emitted(), number, False)
        yield _batch(bins.open_pieces(), number, True)

    def merged(table):
        group = table.column("partition")[0].as_py() // MERGED_PARTITIONS
        order = np.lexsort((table.column("offset"), table.column("sequence_id")))
        pieces = table.take(pa.array(order)).select(NAMES).to_pylist()
        laid = Laid((1 << 62) + (group << 32), window)
        for piece in pieces:
            laid.add(piece)
        return pa.Table.from_batches([_batch(laid.finish(), 0, False).select(NAMES)])

    pieces = cut(rows.mapInArrow(placed, f"{PIECE}, partition bigint, is_open boolean"))
    left = (
        pieces.where("is_open")
        .groupBy(F.floor(F.col("partition") / MERGED_PARTITIONS))
        .applyInArrow(merged, PIECE)
    )
    return pieces.where("NOT is_open").select(*NAMES).unionByName(left).withColumnRenamed("doc_id", id_col)


def _batch(pieces: list[tuple], partition: int, is_open: bool) -> pa.RecordBatch:
    kinds = [pa.int64()] * 6 + [pa.binary()]
    columns = zip(*pieces, strict=True) if pieces else [[]] * len(NAMES)
    arrays = [pa.array(list(x), kind) for x, kind in zip(columns, kinds, strict=True)]
    n = len(pieces)
    arrays += [pa.array([partition] * n, pa.int64()), pa.array([is_open] * n, pa.bool_())]
    return pa.RecordBatch.from_arrays(arrays, [*NAMES, "partition", "is_open"])


class Windows:
    """The open windows of a partition, by free places."""

    def __init__(self, first_id: int, window: int, most_open: int, max_gap: int):
        self.next_id, self.window, self.most_open = first_id, window, most_open
        self.max_gap = max_gap
        self.free: list[tuple[int, int]] = []  # (free places, sequence id), ascending
        self.pieces: dict[int, list[tuple]] = {}
        self.done: list[tuple] = []

    def add(self, doc_id, ids: np.ndarray) -> None:
        total, at = len(ids), 0
        while at < total:
            rest = total - at
            if rest >= self.window:
                self.done += self._put([], self._new_id(), doc_id, ids, at, self.window, 0)
                at += self.window
                continue
            place = bisect_left(self.free, (rest, -1))
            if place < len(self.free):
                at += self._fill(place, doc_id, ids, at, rest)
            elif len(self.free) < self.most_open:
                insort(self.free, (self.window, self._new_id()))
            else:  # none fits: the fullest one leaves
                gap, sequence = self.free[0]
                if gap > self.max_gap:
                    at += self._fill(0, doc_id, ids, at, gap)
                else:
                    self.free.pop(0)
                    self.done += self.pieces.pop(sequence)

    def _new_id(self) -> int:
        self.next_id += 1
        return self.next_id - 1

    def _fill(self, place: int, doc_id, ids, at: int, length: int) -> int:
        free, sequence = self.free.pop(place)
        own = self.pieces.setdefault(sequence, [])
        self._put(own, sequence, doc_id, ids, at, length, self.window - free)
        if free == length:
            self.done += self.pieces.pop(sequence)
        else:
            insort(self.free, (free - length, sequence))
        return length

    def _put(self, pieces, sequence, doc_id, ids, at, length, offset) -> list[tuple]:
        own = ids[at : at + length].tobytes()
        pieces.append((doc_id, at, length, len(ids), sequence, offset, own))
        return pieces

    def emitted(self) -> list[tuple]:
        found, self.done = self.done, []
        return found

    def open_pieces(self) -> list[tuple]:
        return [piece for pieces in self.pieces.values() for piece in pieces]


class Laid:
    """Pieces laid end to end and cut into full windows."""

    def __init__(self, first_id: int, window: int):
        self.sequence, self.window, self.offset = first_id, window, 0
        self.done: list[tuple] = []

    def add(self, piece: dict) -> None:
        self._add(piece, self.window)

    def _add(self, piece: dict, window: int) -> None:
        at = 0
        while at < piece["length"]:
            length = min(piece["length"] - at, window - self.offset)
            self.done.append(
                (
                    piece["doc_id"], piece["start"] + at, length, piece["doc_tokens"],
                    self.sequence, self.offset, piece["ids"][4 * at : 4 * (at + length)],
                )
            )
            at += length
            self.offset += length
            if self.offset == window:
                self.sequence, self.offset = self.sequence + 1, 0

    def finish(self) -> list[tuple]:
        """All pieces; those of the last window are cut to powers of two."""
        last = [piece for piece in self.done if piece[4] == self.sequence]
        self.done = [piece for piece in self.done if piece[4] != self.sequence]
        rest, self.offset = sum(piece[2] for piece in last), 0
        sizes = [1 << bit for bit in range(rest.bit_length() - 1, -1, -1) if rest >> bit & 1]
        queue = [dict(zip(NAMES, piece, strict=True)) for piece in last]
        for size in sizes:
            room = size
            while room:
                piece = queue.pop(0)
                taken = min(room, piece["length"])
                head = piece | {"length": taken, "ids": piece["ids"][: 4 * taken]}
                self._add(head, size)
                room -= taken
                if taken < piece["length"]:
                    queue.insert(
                        0,
                        piece
                        | {
                            "start": piece["start"] + taken,
                            "length": piece["length"] - taken,
                            "ids": piece["ids"][4 * taken :],
                        },
                    )
        return self.done


def digests(pieces: DataFrame) -> DataFrame:
    """The pieces with a checksum in place of the ids."""
    few_rows_a_batch(pieces.sparkSession)
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
