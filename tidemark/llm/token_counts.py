"""Token counts of a corpus from an exact histogram of encoded lengths.

Tasks encode the documents and only lengths leave them. One grouping gives documents per length;
suffix sums over the lengths then answer totals, quantiles and totals under any context limit.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.text import documents, slices
from tidemark.llm.vocabulary import BYTE_BPE, encoded_with_added, path
from tidemark.session import cut

# Lengths of one slice of the suffix sums.
SLICE_LENGTHS = 1_024


def lengths(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary: str | None = None,
) -> DataFrame:
    """(n_tokens) of every row of `docs`. Null and empty texts have 0 tokens; ids do not matter."""
    file = vocabulary or path(BYTE_BPE)

    def counted(batches):
        for batch in slices(batches):
            texts = batch.column("text").to_pylist()
            sizes = (len(encoded_with_added(file, x.decode())) for x in texts)
            found = np.fromiter(sizes, np.int64, len(texts))
            yield pa.RecordBatch.from_pydict({"n_tokens": found})

    return documents(docs, id_col, text_col).select("text").mapInArrow(counted, "n_tokens bigint")


def length_histogram(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary: str | None = None,
) -> DataFrame:
    """One row per encoded length that occurs.

    n_tokens, n_docs; docs_from and tokens_from: documents of at least this length and their
    tokens; docs_to: documents of at most this length; tokens_total; tokens_cut: tokens of the
    corpus when every document is cut to this length. An empty table has no rows.
    """
    histogram = cut(
        lengths(docs, id_col, text_col, vocabulary)
        .groupBy("n_tokens")
        .agg(F.count(F.lit(1)).alias("n_docs"))
        .withColumn("slice", F.floor(F.col("n_tokens") / SLICE_LENGTHS))
    )
    weighted = F.col("n_tokens") * F.col("n_docs")
    # Suffix sums of the slices, then inside each slice. There is a slice for every SLICE_LENGTHS
    # tokens of the longest document at most.
    behind = Window.orderBy(F.desc("slice")).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    slices_behind = (
        histogram.groupBy("slice")
        .agg(F.sum("n_docs").alias("docs"), F.sum(weighted).alias("tokens"))
        .select(
            "slice",
            F.coalesce(F.sum("docs").over(behind), F.lit(0)).alias("docs_behind"),
            F.coalesce(F.sum("tokens").over(behind), F.lit(0)).alias("tokens_behind"),
            F.sum("docs").over(every).alias("docs_total"),
            F.sum("tokens").over(every).alias("tokens_total"),
        )
    )
    inside = (
        Window.partitionBy("slice")
        .orderBy(F.desc("n_tokens"))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        histogram.withColumn("docs_inside", F.sum("n_docs").over(inside))
        .withColumn("tokens_inside", F.sum(weighted).over(inside))
        .join(slices_behind, "slice")
        .withColumn("docs_from", F.col("docs_behind") + F.col("docs_inside"))
        .withColumn("tokens_from", F.col("tokens_behind") + F.col("tokens_inside"))
        .select(
            "n_tokens",
            "n_docs",
            "docs_from",
            "tokens_from",
            (F.col("docs_total") - F.col("docs_from") + F.col("n_docs")).alias("docs_to"),
            "tokens_total",
            (
                F.col("tokens_total")
                - F.col("tokens_from")
                + F.col("n_tokens") * F.col("docs_from")
            ).alias("tokens_cut"),
        )
    )


def cut_totals(histogram: DataFrame, limits: Sequence[int]) -> dict[int, int]:
    """Tokens of the corpus when every document is cut to each of the limits, in one pass."""
    sums = [
        F.sum(F.least("n_tokens", F.lit(limit)) * F.col("n_docs")).alias(f"cut_{i}")
        for i, limit in enumerate(limits)
    ]
    found = histogram.agg(*sums).first()
    return {limit: found[i] or 0 for i, limit in enumerate(limits)}


def quantiles(histogram: DataFrame, shares: Sequence[float]) -> dict[float, int | None]:
    """The smallest length that at least each share of the documents does not exceed."""
    total = F.col("docs_to") + F.col("docs_from") - F.col("n_docs")
    found = histogram.agg(
        *[
            F.min(F.when(F.col("docs_to") >= F.lit(share) * total, F.col("n_tokens"))).alias(f"q_{i}")
            for i, share in enumerate(shares)
        ]
    ).first()
    return {share: found[i] for i, share in enumerate(shares)}
