"""Exact duplicates by sorting the contents.

Sampled splitters deal the rows to ranges of the order (first bytes, digest, share, normalised
text); each range is sorted externally, so equal texts become neighbours and the window compares
them in full. Of each run of equal texts the smallest id stays.

A digest with more than `hot_rows` rows is dealt out in shares of about that size; the few rows
that stand for its shares are merged afterwards. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import cut

HOT_ROWS = 1_000
PREFIX_CHARS = 16
# Rows of hot digests that are broadcast at most (about 20 bytes each); beyond, Spark shuffles.
BROADCAST_ROWS = 200_000


def normalised(text: Column) -> Column:
    """Runs of white space as one space, null as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def exact_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hot_rows: int = HOT_ROWS
) -> DataFrame:
    """One row per row of `docs`: id, keep_id, group_size, kept, text_sha256 of the normalised text.

    Null and empty texts are equal to each other, and differ from a text of one space. A null id
    comes after all others; keep_id is null only where all ids of the group are. Of rows that also
    share the id, one is kept. Other columns are not read. An empty table gives an empty result.
    """
    rows = docs.select(
        F.col(id_col).alias("doc_id"), normalised(F.col(text_col)).alias("norm")
    ).withColumn("digest", F.xxhash64("norm"))
    hot = cut(
        rows.groupBy("digest")
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .where(F.col("n_rows") > hot_rows)
        .select("digest", F.ceil(F.col("n_rows") / hot_rows).cast("int").alias("shares"))
    )
    listed = F.broadcast(hot) if hot.count() <= BROADCAST_ROWS else hot
    dealt = rows.join(listed, "digest", "left").select(
        "doc_id",
        "norm",
        "digest",
        F.substring("norm", 1, PREFIX_CHARS).alias("head"),
        F.when(
            F.col("shares").isNotNull(),
            F.pmod(F.xxhash64("doc_id"), F.col("shares")).cast("int"),
        )
        .otherwise(0)
        .alias("share"),
        F.col("shares").isNotNull().alias("is_hot"),
    )
    order = ["head", "digest", "share"]
    equal = Window.partitionBy(*order, "norm").orderBy(F.col("doc_id").asc_nulls_last())
    whole = equal.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    n_ranges = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    runs = cut(
        dealt.repartitionByRange(n_ranges, *order).select(
            "doc_id",
            "is_hot",
            F.min("doc_id").over(whole).alias("keep_id"),
            F.count(F.lit(1)).over(whole).alias("group_size"),
            F.row_number().over(equal).alias("place"),
            F.sha2("norm", 256).alias("text_sha256"),
        )
    )
    return _merged(runs, id_col)


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` that `exact_dedup` keeps, with all of their columns."""
    kept = (
        exact_dedup(docs, id_col, text_col)
        .where("kept")
        .select(F.col(id_col).alias("_id"), F.col("text_sha256").alias("_digest"))
    )
    rows = docs.select(
        F.struct("*").alias("row"),
        F.col(id_col).alias("doc_id"),
        F.sha2(normalised(F.col(text_col)), 256).alias("digest"),
    )
    # The digest first: it is never null, and no key of the join is hot, as one id is kept of each.
    same = (F.col("digest") == F.col("_digest")) & F.col("doc_id").eqNullSafe(F.col("_id"))
    return rows.join(kept, same, "left_semi").dropDuplicates(["digest", "doc_id"]).select("row.*")


def _merged(runs: DataFrame, id_col: str) -> DataFrame:
    """Puts the shares of hot texts together again."""
    single = runs.where("NOT is_hot").select(
        "doc_id", "keep_id", "group_size", (F.col("place") == 1).alias("kept"), "text_sha256"
    )
    hot = runs.where("is_hot")
    # One row for each share; its first row stands for it.
    shares = hot.where("place = 1")
    groups = shares.groupBy("text_sha256").agg(
        F.min("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size")
    )
    # Shares are dealt by id, so the rows with the smallest id are all in one share.
    merged = (
        hot.drop("keep_id", "group_size")
        .join(groups, "text_sha256")
        .select(
            "doc_id",
            "keep_id",
            "group_size",
            ((F.col("place") == 1) & F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("kept"),
            "text_sha256",
        )
    )
    return single.unionByName(merged).withColumnRenamed("doc_id", id_col)


SQL = r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm
           FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
FROM n WINDOW w AS (PARTITION BY norm)"""
