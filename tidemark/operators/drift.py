"""Population stability of features against a stored reference.

Reference: per feature, edges at the quantiles of its values, and the share of rows in each bin
between them; rows without a value (null or NaN) fill a bin of their own. Index: the sum over the
bins of `(now - then) * ln(now / then)`, graded by the fixed limits below.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.values import ALERT, OK, WARNING, null_if_nan
from tidemark.operators.hot import running_totals
from tidemark.operators.stretches import counts_by_stretch, counts_by_value
from tidemark.session import cut, discard

# The conventional limits, and the share an empty bin counts as.
PSI_WARNING = 0.1
PSI_ALERT = 0.25
SHARE_FLOOR = 1e-4


def value_counts(values: DataFrame) -> DataFrame:
    """Rows per feature and distinct value, missing values as null, written once.

    Everything below works on these counts, so the values themselves are read a single time and
    a value that fills a large part of the table arrives as one row.
    """
    counted = (
        values.select("feature_name", null_if_nan(F.col("value")).alias("value"))
        .groupBy("feature_name", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return cut(counted)


def deciding_counts(
    wide: DataFrame, features: Sequence[str], bins: int, slices: int | None = None
) -> DataFrame:
    """`value_counts` of some columns, by value only where a quantile lies.

    `feature_name, value, n` of the present values. Rows are counted by stretch of values; the few
    stretches that hold a rank in demand are counted by value, and any other is one row at its
    largest value. `quantiles` into `bins` parts, or into a divisor of that, are the same and as
    exact, but columns of mostly distinct values are not grouped and sorted as a whole.
    """
    stretches = cut(counts_by_stretch(wide, features))
    found = _at_ranks(stretches, bins, slices).select("feature_name", "stretch").distinct()
    wanted: dict[str, list[int]] = {}
    for row in found.collect():
        wanted.setdefault(row["feature_name"], []).append(row["stretch"])
    decided = F.lit(False)
    for name, own in wanted.items():
        decided = decided | ((F.col("feature_name") == name) & F.col("stretch").isin(own))
    rest = stretches.where(~decided).select("feature_name", "value", "n")
    counts = cut(rest.unionByName(counts_by_value(wide, features, wanted)))
    discard(stretches)
    return counts


def _at_ranks(counts: DataFrame, bins: int, slices: int | None) -> DataFrame:
    """The rows of the counts that hold a rank at or next to a quantile, once per such quantile.

    With m + 1 values the k-th quantile is at rank k * m / bins: column `at` is k * m.
    """
    up_to = running_totals(counts, ["feature_name"], "value", {"upto": "n"}, slices)
    targets = (
        counts.groupBy("feature_name")
        .agg(F.sum("n").alias("size"))
        .where(F.col("size") >= 2)
        .select(
            "feature_name",
            F.transform(
                F.sequence(F.lit(1), F.lit(bins - 1)),
                lambda k: F.struct(k.alias("k"), (k * (F.col("size") - 1)).alias("at")),
            ).alias("targets"),
        )
    )
    # A distinct value covers the ranks [upto - n, upto); a quantile needs rank and rank + 1
    rank, starts = F.expr(f"at div {bins}"), F.col("upto") - F.col("n")
    return (
        up_to.join(F.broadcast(targets), "feature_name")
        .select(*counts.columns, "upto", F.inline("targets"))
        .where((rank + 1 >= starts) & (rank < F.col("upto")))
    )


def quantiles(counts: DataFrame, bins: int, slices: int | None = None) -> DataFrame:
    """`feature_name, k, quantile`: the inner quantiles that cut the values into `bins` parts.

    Inclusive quantiles: with m + 1 values the k-th lies at rank k * m / bins, interpolated between
    neighbours. Ranks are whole numbers, so a quantile is exact and not an ulp beside a value.
    Features with fewer than two values have none.
    """
    found = _at_ranks(counts.where(F.col("value").isNotNull()), bins, slices)
    rank, starts = F.expr(f"at div {bins}"), F.col("upto") - F.col("n")
    neighbours = found.groupBy("feature_name", "k", "at").agg(
        F.max(F.when((rank >= starts) & (rank < F.col("upto")), F.col("value"))).alias("low"),
        F.max(F.when((rank + 1 >= starts) & (rank + 1 < F.col("upto")), F.col("value"))).alias(
            "high"
        ),
    )
    rest = F.col("at") % bins
    between = (F.col("low") * (bins - rest) + F.coalesce("high", "low") * rest) / float(bins)
    return neighbours.select("feature_name", "k", between.alias("quantile"))


def quantile_edges(counts: DataFrame, bins: int = 10, slices: int | None = None) -> DataFrame:
    """`feature_name, edges`: the quantiles of each feature in order, repeated ones merged."""
    return (
        quantiles(counts, bins, slices)
        .groupBy("feature_name")
        .agg(F.array_sort(F.collect_set("quantile")).alias("edges"))
    )


def bin_number(value: Column, edges: Column) -> Column:
    """Bins from 0; a value equal to an edge belongs below it, missing values to the last bin."""
    return F.when(value.isNull(), F.size(edges) + 1).otherwise(
        F.size(F.filter(edges, lambda edge: edge < value))
    )


def bin_shares(counts: DataFrame, edges: DataFrame) -> DataFrame:
    """`feature_name, edges, shares`: the share of rows per bin, for every feature with edges.

    `edges` has one small row per feature; a feature without rows in `counts` gets null shares.
    """
    binned = (
        counts.join(F.broadcast(edges), "feature_name")
        .groupBy("feature_name", bin_number(F.col("value"), F.col("edges")).alias("bin"))
        .agg(F.sum("n").alias("n"))
        .groupBy("feature_name")
        .agg(
            F.map_from_entries(F.collect_list(F.struct("bin", "n"))).alias("filled"),
            F.sum("n").alias("size"),
        )
    )
    bins = F.sequence(F.lit(0), F.size("edges") + 1)
    share = lambda number: (
        F.coalesce(F.try_element_at(F.col("filled"), number), F.lit(0)) / F.col("size")
    )
    return edges.join(binned, "feature_name", "left").select(
        "feature_name",
        "edges",
        F.when(F.col("size").isNotNull(), F.transform(bins, share)).alias("shares"),
    )


def reference_distribution(
    values: DataFrame, bins: int = 10, slices: int | None = None
) -> DataFrame:
    """`feature_name, edges, shares` of long values, all features in one job."""
    return counted_distribution(value_counts(values), bins, slices)


def counted_distribution(
    counts: DataFrame, bins: int = 10, slices: int | None = None
) -> DataFrame:
    """The same out of counts per feature and value, such as those that add up from many days."""
    edges = quantile_edges(counts, bins, slices)
    named = counts.select("feature_name").distinct().join(edges, "feature_name", "left")
    every = named.withColumn(
        "edges", F.coalesce("edges", F.array().cast("array<double>"))
    )
    return bin_shares(counts, cut(every))


def stability_index(reference: DataFrame, counts: DataFrame) -> DataFrame:
    """`feature_name, psi` against the reference; null where there is nothing to compare."""
    now = bin_shares(counts, reference.select("feature_name", "edges")).select(
        "feature_name", F.col("shares").alias("now")
    )
    floored = lambda share: F.greatest(share, F.lit(SHARE_FLOOR))
    per_bin = F.zip_with(
        "shares",
        "now",
        lambda then, now: (floored(now) - floored(then)) * F.log(floored(now) / floored(then)),
    )
    psi = F.aggregate(per_bin, F.lit(0.0), lambda total, part: total + part)
    return reference.join(now, "feature_name", "left").select(
        "feature_name", F.when(F.col("now").isNotNull(), psi).alias("psi")
    )


def drift_checks(reference: DataFrame, snapshot: DataFrame, as_of: datetime) -> DataFrame:
    """A check `psi` per feature of the reference against its values at `as_of`."""
    counts = (
        snapshot.select("feature_name", null_if_nan(F.col("value")).alias("value"))
        .groupBy("feature_name", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    psi = F.col("psi")
    return stability_index(reference, counts).select(
        F.col("feature_name").alias("name"),
        F.lit("psi").alias("metric"),
        psi.alias("value"),
        F.when(psi >= PSI_ALERT, ALERT)
        .when(psi.isNull() | (psi >= PSI_WARNING), WARNING)
        .otherwise(OK)
        .alias("status"),
        F.when(psi.isNull(), f"not checked: no values for {as_of.isoformat()}")
        .otherwise(
            F.concat(
                F.format_string("PSI %.3f", psi),
                F.lit(
                    " against the model's training data "
                    f"(warning from {PSI_WARNING}, alert from {PSI_ALERT})"
                ),
            )
        )
        .alias("message"),
    )
