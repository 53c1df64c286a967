"""How well scores and predictions match 0/1 labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.hot import running_totals
from tidemark.operators.ordered import COMBINED, combined_scores, measured_slices, slice_of
from tidemark.session import cut, discard


def classification_metrics(
    predicted: DataFrame, by: Sequence[str] = (), prediction: str = "prediction"
) -> DataFrame:
    """Accuracy, precision, recall and the share of positives, in one pass.

    Precision is 0 when nothing was predicted positive, recall when nothing was positive.
    """
    yes, buys = F.col(prediction) == 1, F.col("label") == 1
    hits = F.count_if(yes & buys)
    ratio = lambda part, whole: F.coalesce(F.try_divide(part, whole), F.lit(0.0))
    return predicted.groupBy(*by).agg(
        F.avg((F.col(prediction) == F.col("label")).cast("int")).alias("accuracy"),
        ratio(hits, F.count_if(yes)).alias("precision"),
        ratio(hits, F.count_if(buys)).alias("recall"),
        F.avg("label").alias("base_rate"),
    )


def score_counts(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Positives and negatives per distinct score, written once.

    Ranking metrics need only these counts; rows with equal scores shrink to one.
    """
    return cut(
        scored.groupBy(*by, F.col("score").cast("double").alias("score")).agg(
            F.count_if(F.col("label") == 1).alias("positives"),
            F.count_if(F.col("label") == 0).alias("negatives"),
        )
    )


def roc_auc(counts: DataFrame, by: Sequence[str] = (), slices: int | None = None) -> DataFrame:
    """The chance that a positive scores above a negative, ties counting half; column `roc_auc`."""
    ranked = running_totals(counts, by, "score", {"negatives_upto": "negatives"}, slices)
    positives, negatives = F.col("positives").cast("double"), F.col("negatives").cast("double")
    below = F.col("negatives_upto") - negatives / 2
    return ranked.groupBy(*by).agg(
        F.try_divide(
            F.sum(positives * below), F.sum(positives) * F.sum(negatives)
        ).alias("roc_auc")
    )


def precision_at_recall(
    counts: DataFrame, wanted_recall: float, by: Sequence[str] = (), slices: int | None = None
) -> DataFrame:
    """The best precision of any cut-off whose recall is at least the wanted one.

    A cut-off predicts "yes" for every score at or above it, so scores are added up from the top.
    """
    # A constant group stands in when there is none, so the totals join by key
    group = list(by) or ["_all"]
    downwards = counts.withColumns({"_all": F.lit(0), "_from_top": -F.col("score")})
    from_top = running_totals(
        downwards, group, "_from_top", {"hits": "positives", "misses": "negatives"}, slices
    )
    totals = downwards.groupBy(*group).agg(F.sum("positives").alias("all_positives"))
    recall = F.col("hits") / F.col("all_positives")
    precision = F.col("hits") / (F.col("hits") + F.col("misses"))
    best = F.max(F.when(recall >= wanted_recall, precision))
    # Recall 0 is also reached by predicting nobody, at precision 1
    return (
        from_top.join(totals, group)
        .groupBy(*by)
        .agg((F.lit(1.0) if wanted_recall <= 0 else best).alias("precision"))
    )


def ranking(
    scored: DataFrame, scores: Sequence[str], wanted_recall: float, slices: int | None = None
) -> dict[tuple[str, int], tuple[float | None, float | None]]:
    """ROC AUC and precision at a wanted recall of some columns of scores per number of column `part`.

    The same numbers as `roc_auc` and `precision_at_recall`, for few parts and for scores that
    hardly ever repeat: rows are read once for all columns, and equal scores are only combined
    inside tasks. The scores are cut into slices at fixed bounds; what lies below a slice is known
    from the totals of the slices, so each slice is sorted and measured on its own. NaN and null
    count as the highest score.
    """
    slices = slices or int(scored.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = scored.select(
        F.col("part").cast("int").alias("part"),
        F.when(F.col("label") == 1, 1).when(F.col("label") == 0, 0).otherwise(2).alias("label"),
        *[F.col(name).cast("double").alias(f"_{n}") for n, name in enumerate(scores)],
    )
    combined = cut(rows.mapInArrow(combined_scores(len(scores)), COMBINED))
    shares = F.array(*[F.lit(n / slices) for n in range(1, slices)])
    found = combined.agg(F.percentile_approx("score", shares, max(1000, 10 * slices))).first()[0]
    combined = combined.withColumn("slice", slice_of(found or [])(F.col("score")))
    sums = combined.groupBy("group", "slice").agg(
        F.sum("positives").alias("positives"), F.sum("negatives").alias("negatives")
    )
    below: dict[tuple[int, int], tuple[int, int]] = {}
    totals: dict[int, tuple[int, int]] = {}
    for group, number, positives, negatives in sorted(map(tuple, sums.collect())):
        before = totals.get(group, (0, 0))
        below[group, number] = before
        totals[group] = before[0] + positives, before[1] + negatives
    in_order = combined.repartition(slices, "group", "slice").sortWithinPartitions(
        "group", "slice", "score"
    )
    parts = in_order.mapInArrow(
        measured_slices(below, totals, wanted_recall), "group int, area double, precision double"
    ).collect()
    discard(combined)
    measured = {}
    for group, (positives, negatives) in totals.items():
        part, place = divmod(group, len(scores))
        own = [part for part in parts if part["group"] == group]
        pairs = float(positives) * float(negatives)
        auc = sum(part["area"] for part in own) / pairs if pairs else None
        best = [part["precision"] for part in own if part["precision"] is not None]
        measured[scores[place], part] = auc, 1.0 if wanted_recall <= 0 else max(best, default=None)
    return measured
