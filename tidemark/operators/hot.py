"""Keys that hold too many rows for one task.

Grouping with `max`, `sum` or `count` combines on the map side and needs nothing from here. Joins
and windows do not: they bring all rows of a key to one task. The operators below find the keys
above `hot_rows` rows and treat those apart, so every task stays near that size while every row is
kept. N rows hold fewer than N / hot_rows such keys, which bounds what is collected and broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import cut

HOT_ROWS = 5_000_000


def hot_keys(rows: DataFrame, keys: Sequence[str], hot_rows: int) -> DataFrame | None:
    """The keys with more than `hot_rows` rows and their row counts, or None without any."""
    counts = rows.dropna(subset=list(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
    found = counts.where(F.col("n_rows") > hot_rows).collect()
    return rows.sparkSession.createDataFrame(found, counts.schema) if found else None


def split(rows: DataFrame, hot: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """The rows without and with a hot key. Rows with a null key count as not hot."""
    listed = F.broadcast(hot.select(*keys))
    cold_rows = rows.join(listed, list(keys), "left_anti")
    hot_rows = rows.join(listed, list(keys), "left_semi")
    return cold_rows.select(*rows.columns), hot_rows.select(*rows.columns)


def lookup_join(
    rows: DataFrame, table: DataFrame, keys: Sequence[str], hot_rows: int | None = HOT_ROWS
) -> DataFrame:
    """Left join to a table that has at most one row per key.

    Rows with a hot key meet the few table rows of those keys by broadcast, without a shuffle.
    `hot_rows=None` skips the look for hot keys, for rows known to have none.
    """
    columns = rows.columns + [name for name in table.columns if name not in keys]
    hot = None if hot_rows is None else hot_keys(rows.select(*keys), keys, hot_rows)
    if hot is None:
        return rows.join(table, list(keys), "left").select(*columns)
    cold_part, hot_part = split(rows, hot, keys)
    _, hot_table = split(table, hot, keys)
    joined = cold_part.join(table, list(keys), "left").unionByName(
        hot_part.join(F.broadcast(hot_table), list(keys), "left")
    )
    return joined.select(*columns)


def sliced(rows: DataFrame, order: Sequence[str], slices: int) -> DataFrame:
    """Sort order cut into about equal slices, numbered by column `_slice`.

    Range partitioning samples its bounds, so the result is written once: every later use of the
    slices sees the same ones, also after an executor is lost.
    """
    ranged = rows.repartitionByRange(slices, *order)
    return cut(ranged.withColumn("_slice", F.spark_partition_id()))


def running_totals(
    rows: DataFrame,
    group: Sequence[str],
    order: str,
    totals: dict[str, str],
    slices: int | None = None,
) -> DataFrame:
    """Running sums within each group, in ascending order, the own row included.

    `totals` maps new columns to the columns they add up. The order of all rows is cut into about
    equal slices, as many as there are shuffle partitions unless `slices` says otherwise: each is
    added up on its own and starts from the total of the slices before it. A slice ends few groups,
    so these starts number slices + groups at most; they are small next to the rows and joined as
    Spark sees fit.
    """
    slices = slices or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = sliced(rows, [*group, order], slices)
    earlier = Window.partitionBy(*group).orderBy("_slice").rowsBetween(
        Window.unboundedPreceding, -1
    )
    starts = (
        ranged.groupBy("_slice", *group)
        .agg(*[F.sum(column).alias(name) for name, column in totals.items()])
        .select(
            "_slice",
            *group,
            *[
                F.coalesce(F.sum(name).over(earlier), F.lit(0)).alias(f"_start_{name}")
                for name in totals
            ],
        )
    )
    in_slice = Window.partitionBy("_slice", *group).orderBy(order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    summed = ranged.select(
        "*", *[F.sum(column).over(in_slice).alias(f"_in_{name}") for name, column in totals.items()]
    )
    return summed.join(starts, ["_slice", *group]).select(
        *rows.columns,
        *[(F.col(f"_start_{name}") + F.col(f"_in_{name}")).alias(name) for name in totals],
    )
