"""Byte-level BPE of whole texts, long ones in overlapping chunks.

A text of more than `chunk_chars` characters is cut into chunks that overlap. The chunks are split
into pre-tokens in parallel, wherever Spark puts them. A chunk that begins inside a pre-token goes
wrong at first, but the pattern looks only forward, so from the first boundary that it shares with
the chunk before it on, both agree: there they are stitched. The pieces between the stitches are
encoded in parallel and the ids put in order. Chunks without a shared boundary (one pre-token
longer than the overlap) are joined and split together. Decoding concatenates the tokens' bytes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex
from public_tokenizers import PATTERN
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.text import documents, few_rows_a_batch, slices
from tidemark.llm.vocabulary import MULTI_BPE, encoded, path, token_bytes

CHUNK_CHARS = 32_768
OVERLAP_CHARS = 512
# Boundaries this near to the end of a chunk may still move with what follows.
UNSURE_CHARS = 8
UNSURE_TOKENS = 2


def encode(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    ranks: str | None = None,
    chunk_chars: int = CHUNK_CHARS,
    overlap_chars: int = OVERLAP_CHARS,
) -> DataFrame:
    """One row per row of `docs`: id, n_tokens, ids as little-endian unsigned 32-bit integers.

    The ids are those of the whole text, with special tokens as ordinary text; null is empty and
    has none. Ids of documents are carried along; rows that repeat an id are encoded each on its
    own, also if it is null. Other columns are not read.
    """
    file = ranks or path(MULTI_BPE)
    few_rows_a_batch(docs.sparkSession)
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )
    kind = rows.schema["doc_id"].dataType.simpleString()
    is_long = F.length("text") > chunk_chars
    short = documents(rows.where(~is_long)).mapInArrow(
        _encode_rows(file), f"doc_id {kind}, ids binary"
    )
    pieces = _stitched(_chunks(rows.where(is_long), chunk_chars, overlap_chars), overlap_chars)
    parts = pieces.mapInArrow(
        _encode_pieces(file, overlap_chars),
        f"row bigint, doc_id {kind}, piece int, ids binary",
    )
    long = parts.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"),
        F.array_sort(F.collect_list(F.struct("piece", "ids"))).alias("parts"),
    )
    joined = F.aggregate(
        "parts", F.lit(b""), lambda so_far, part: F.concat(so_far, part["ids"])
    )
    both = short.unionByName(long.select("doc_id", joined.alias("ids")))
    return both.select(
        F.col("doc_id").alias(id_col),
        (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        "ids",
    )


def decode(rows: DataFrame, ids_col: str = "ids", ranks: str | None = None) -> DataFrame:
    """`rows` with a column `decoded`: the bytes of the ids. Null ids give no bytes."""
    file = ranks or path(MULTI_BPE)
    few_rows_a_batch(rows.sparkSession)

    def decoded(batches):
        table = token_bytes(file)
        for batch in batches:
            found = [
                b"".join(map(table.__getitem__, np.frombuffer(ids or b"", "<u4").tolist()))
                for ids in batch.column(ids_col).to_pylist()
            ]
            columns = [*batch.columns, pa.array(found, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "decoded"])

    kept = rows.drop("decoded")
    schema = T.StructType([*kept.schema.fields, T.StructField("decoded", T.BinaryType())])
    return kept.mapInArrow(decoded, schema)


def _encode_rows(file: str):
    def encode_rows(batches):
        for batch in slices(batches):
            ids = [
                encoded(file, text.decode()).tobytes()
                for text in batch.column("text").to_pylist()
            ]
            yield pa.RecordBatch.from_pydict(
                {"doc_id": batch.column("doc_id"), "ids": pa.array(ids, pa.binary())}
            )

    return encode_rows


def _chunks(rows: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """(row, doc_id, n, last, start, text): a chunk begins `overlap` characters before its own."""
    last = F.floor((F.length("text") - 1) / chunk).cast("int")
    begin = F.greatest(F.col("n") * chunk - overlap, F.lit(0))
    end = (F.col("n") + 1) * chunk
    return (
        rows.select(
            F.monotonically_increasing_id().alias("row"), "doc_id", "text", last.alias("last")
        )
        .select("*", F.explode(F.sequence(F.lit(0), "last")).alias("n"))
        .select(
            "row",
            "doc_id",
            "n",
            "last",
            begin.alias("start"),
            F.substring("text", begin + 1, end - begin).alias("text"),
        )
    )


def _stitched(chunks: DataFrame, overlap: int) -> DataFrame:
    """(row, doc_id, piece, from, to, chunks): what lies between two stitches, with its chunks."""
    kind = chunks.schema["doc_id"].dataType.simpleString()
    columns = f"row bigint, doc_id {kind}, n int, last int, start int, text string"

    def split(batches):
        pattern = regex.compile(PATTERN)
        for batch in batches:
            heads, tails = [], []
            for n, start, text in zip(
                *(batch.column(name).to_pylist() for name in ("n", "start", "text")), strict=True
            ):
                ends = np.fromiter((m.end() for m in pattern.finditer(text)), np.int64)
                sure = ends[: -UNSURE_TOKENS]
                sure = sure[sure <= len(text) - UNSURE_CHARS]
                heads.append((sure[sure <= overlap] + start).tolist() if n else [])
                tails.append((sure[sure >= len(text) - overlap] + start).tolist())
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.array(heads, pa.list_(pa.int64())),
                    pa.array(tails, pa.list_(pa.int64())),
                ],
                [*batch.schema.names, "head", "tail"],
            )

    spread = chunks.repartition("row", "n").mapInArrow(
        split, f"{columns}, head array<bigint>, tail array<bigint>"
    )
    in_order = Window.partitionBy("row").orderBy("n")
    shared = F.array_min(F.array_intersect("head", F.lag("tail").over(in_order)))
    pieces = Window.partitionBy("row", "piece")
    return (
        spread.withColumn("stitch", F.when(F.col("n") == 0, 0).otherwise(shared))
        .withColumn("piece", F.count("stitch").over(in_order).cast("int"))
        .withColumn("from", F.min("stitch").over(pieces))
        .groupBy("row", "piece")
        .agg(
            F.first("doc_id").alias("doc_id"),
            F.min("from").alias("from"),
            F.array_sort(F.collect_list(F.struct("n", "start", "text"))).alias("chunks"),
        )
        .withColumn("to", F.lead("from").over(Window.partitionBy("row").orderBy("piece")))
    )


def _encode_pieces(file: str, overlap: int):
    def encode_pieces(batches):
        for batch in batches:
            found = []
            for chunks, begin, end in zip(
                *(batch.column(name).to_pylist() for name in ("chunks", "from", "to")), strict=True
            ):
                start = chunks[0]["start"]
                text = "".join(
                    x["text"] if i == 0 else x["text"][overlap:] for i, x in enumerate(chunks)
                )
                # The stitch with the next piece may lie in its overlap, inside this text.
                own = text[begin - start : None if end is None else end - start]
                found.append(encoded(file, own).tobytes())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row"),
                    batch.column("doc_id"),
                    batch.column("piece"),
                    pa.array(found, pa.binary()),
                ],
                ["row", "doc_id", "piece", "ids"],
            )

    return encode_pieces
