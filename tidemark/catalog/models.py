"""Model metrics, baselines and models on the monthly training set."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tidemark.catalog.base import query, work_folder
from tidemark.catalog.joins import TRAINING_SQL, training_frame
from tidemark.operators.metrics import (
    classification_metrics, precision_at_recall, roc_auc, score_counts,
)
from tidemark.plans.modeling import (
    MODEL_NAME, baselines, compare_models, counts_for_models, fit_boosting, fit_logistic, score,
    temporal_split, train_and_register, weights,
)
from tidemark.plans.purchase_stats import FEATURES
from tidemark.plans.store import FeatureStore
from tidemark.session import cut

TEST_FROM = datetime(2000, 1, 1, tzinfo=UTC)
_BASELINES_SQL = f"""{TRAINING_SQL},
b AS (SELECT 'always_no' AS model, label, 0.0 AS score, 0 AS prediction FROM t
      WHERE event_timestamp >= TIMESTAMP '2000-01-01'
      UNION ALL
      SELECT 'ordered_last_30d', label, order_count_30d, CAST(order_count_30d > 0 AS INTEGER) FROM t
      WHERE event_timestamp >= TIMESTAMP '2000-01-01')"""


@query(
    f"""{TRAINING_SQL} SELECT event_timestamp >= TIMESTAMP '2000-01-01' AS is_test,
       count(*) AS n, round(avg(label), 6) AS label_rate FROM t GROUP BY ALL""",
    name="temporal_split",
)
def training_split(spark, folder):
    train, test = temporal_split(training_frame(spark, folder), TEST_FROM)
    both = train.withColumn("is_test", F.lit(False)).unionByName(
        test.withColumn("is_test", F.lit(True))
    )
    return both.groupBy("is_test").agg(
        F.count(F.lit(1)).alias("n"), F.avg("label").alias("label_rate")
    )


def _baselines(spark, folder):
    return baselines(temporal_split(training_frame(spark, folder), TEST_FROM)[1])


@query(
    f"""{_BASELINES_SQL} SELECT model, round(avg(CAST(prediction = label AS INT)), 6) AS accuracy,
       round(coalesce(count(*) FILTER (WHERE prediction = 1 AND label = 1)
             / nullif(count(*) FILTER (WHERE prediction = 1), 0), 0), 6) AS precision,
       round(coalesce(count(*) FILTER (WHERE prediction = 1 AND label = 1)
             / nullif(count(*) FILTER (WHERE label = 1), 0), 0), 6) AS recall,
       round(avg(label), 6) AS base_rate FROM b GROUP BY model"""
)
def baseline_metrics(spark, folder):
    return classification_metrics(_baselines(spark, folder), ["model"])


_AUC_SQL = f"""{TRAINING_SQL},
x AS (SELECT label, CAST(coalesce(days_since_last_order, -1) AS DOUBLE) AS score FROM t),
r AS (SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0
             AS place FROM x),
n AS (SELECT count(*) FILTER (WHERE label = 1)::DOUBLE AS p,
             count(*) FILTER (WHERE label = 0)::DOUBLE AS q FROM x)
SELECT round(((SELECT sum(place) FROM r WHERE label = 1) - p * (p + 1) / 2) / (p * q), 6) AS roc_auc
FROM n"""


def _recency_counts(spark, folder):
    frame = training_frame(spark, folder)
    recency = F.coalesce(F.col("days_since_last_order"), F.lit(-1.0))
    return score_counts(frame.select("label", recency.alias("score")))


@query(_AUC_SQL, name="roc_auc_rank")
def roc_auc_of_recency(spark, folder):
    return roc_auc(_recency_counts(spark, folder))


@query(_AUC_SQL)
def roc_auc_sliced(spark, folder):
    """The same with ranks added up over twenty slices of the distinct scores."""
    return roc_auc(_recency_counts(spark, folder), slices=20)


@query(
    f"""{TRAINING_SQL},
x AS (SELECT CAST(order_count_30d AS DOUBLE) AS score, count(*) FILTER (WHERE label = 1) AS pos,
             count(*) AS n FROM t GROUP BY score),
c AS (SELECT sum(pos) OVER w AS hits, sum(n) OVER w AS yes, sum(pos) OVER () AS all_pos FROM x
      WINDOW w AS (ORDER BY score DESC ROWS UNBOUNDED PRECEDING))
SELECT round(max(hits / yes), 6) AS precision FROM c WHERE hits / all_pos >= 0.25""",
    name="precision_at_recall",
)
def best_precision_at_recall(spark, folder):
    frame = training_frame(spark, folder)
    counts = score_counts(frame.withColumn("score", F.col("order_count_30d")))
    return precision_at_recall(counts, 0.25)


_TEST_ROWS_SQL = f"""{TRAINING_SQL} SELECT entity_id, event_timestamp, label, TRUE AS consistent
FROM t WHERE event_timestamp >= TIMESTAMP '2000-01-01'"""


def _checked(scored):
    """The rows, and whether their scores are probabilities that fit the predictions."""
    fits = F.col("score").between(0, 1) & ((F.col("score") > 0.5).cast("int") == F.col("prediction"))
    return scored.select("entity_id", "event_timestamp", "label", fits.alias("consistent"))


@query(_TEST_ROWS_SQL, name="lr_scores")
def logistic_scores(spark, folder):
    """Test rows with the probability a logistic regression gives them."""
    train, test = temporal_split(cut(training_frame(spark, folder)), TEST_FROM)
    return _checked(score(fit_logistic(train), test))


@query(_TEST_ROWS_SQL, name="gbt_scores")
def boosting_scores(spark, folder):
    train, test = temporal_split(cut(training_frame(spark, folder)), TEST_FROM)
    return _checked(score(fit_boosting(train, trees=20), test))


_GAPS_SQL = " UNION ALL ".join(
    f"""SELECT 'z_missing_{name}' AS name WHERE EXISTS (SELECT 1 FROM t
        WHERE event_timestamp < TIMESTAMP '2000-01-01' AND {name} IS NULL)"""
    for name in FEATURES
)


@query(
    f"""{TRAINING_SQL} SELECT name, TRUE AS optimal FROM (
       SELECT unnest({[f"z_{name}" for name in FEATURES]}) AS name UNION ALL {_GAPS_SQL})"""
)
def model_weights(spark, folder):
    """The inputs of the logistic regression, and whether their weights are at the optimum.

    There the gradient of the penalised loss is zero: the mean of (score - label) times the input,
    plus the penalty's share of the weight.
    """
    train, _ = temporal_split(cut(training_frame(spark, folder)), TEST_FROM)
    model = fit_logistic(train)
    found = dict(weights(model))
    chance = vector_to_array(F.col("probability")).getItem(1)
    inputs = model.transform(train).withColumn("score", chance)
    error = F.col("score") - F.col("label")
    gradient = inputs.agg(
        *[F.avg(error * F.col(name)).alias(name) for name in found], F.count(F.lit(1)).alias("n")
    ).first()
    rows = [
        (name, abs(gradient[name] + weight / gradient["n"]) < 1e-4)
        for name, weight in found.items()
    ]
    return spark.createDataFrame(rows, "name string, optimal boolean")


@query()
def model_comparison(spark, folder):
    """Both models beside the rule, at the rule's recall."""
    train, test = temporal_split(cut(training_frame(spark, folder)), TEST_FROM)
    counts = counts_for_models(train)
    models = {
        "logistic": fit_logistic(train, counts=counts),
        "boosting": fit_boosting(train, trees=20, counts=counts),
    }
    return compare_models(models, train, test)


@query(
    f"""{_BASELINES_SQL}, x AS (SELECT * FROM b WHERE model = 'ordered_last_30d'),
w AS (SELECT count(*) FILTER (WHERE prediction = 1 AND label = 1)
             / count(*) FILTER (WHERE label = 1) AS recall FROM x),
c AS (SELECT score, sum(count(*) FILTER (WHERE label = 1)) OVER (ORDER BY score DESC) AS hits,
             sum(count(*)) OVER (ORDER BY score DESC) AS yes FROM x GROUP BY score)
SELECT 'ordered_last_30d' AS model, round(any_value(recall), 6) AS recall,
       round(max(hits / yes), 6) AS precision
FROM c, w WHERE hits / (SELECT count(*) FILTER (WHERE label = 1) FROM x) >= recall"""
)
def rule_at_its_recall(spark, folder):
    """The comparison's row for the rule."""
    train, test = temporal_split(cut(training_frame(spark, folder)), TEST_FROM)
    return compare_models({}, train, test).select("model", "recall", "precision")


_SPLITS_SQL = """
versions AS (
      SELECT 1 AS version, TIMESTAMP '2000-01-01' AS test_from, TIMESTAMP '2000-07-01' AS until
      UNION ALL SELECT 2, TIMESTAMP '2001-01-01', TIMESTAMP '2100-01-01'),
p AS (SELECT version, count(*) FILTER (WHERE event_timestamp < test_from) AS train_rows,
             count(*) FILTER (WHERE event_timestamp >= test_from) AS test_rows,
             avg(label) FILTER (WHERE event_timestamp >= test_from) AS test_base_rate
      FROM versions JOIN t ON event_timestamp < until GROUP BY version)"""


@query(
    f"""{TRAINING_SQL}, {_SPLITS_SQL} SELECT CAST(version AS BIGINT) AS version, train_rows,
       test_rows, round(test_base_rate, 6) AS test_base_rate, TRUE AS by_auc FROM p"""
)
def train_and_promote(spark, folder):
    """Train, train again later if that is better: both versions with their splits.

    `by_auc`: the first was promoted, and the second just if its ROC AUC is higher.
    """
    store = FeatureStore(spark, work_folder(spark))
    frame = cut(training_frame(spark, folder))
    earlier = frame.where(F.col("event_timestamp") < F.lit(datetime(2000, 7, 1, tzinfo=UTC)))
    train_and_register(store, earlier, TEST_FROM)
    later = datetime(2001, 1, 1, tzinfo=UTC)
    train_and_register(store, frame, later, promote_if_better=True)
    metric = lambda name: F.try_element_at("metrics", F.lit(name))
    param = lambda name: F.try_element_at("params", F.lit(name)).cast("bigint")
    higher = F.coalesce(metric("roc_auc") > metric("champion_roc_auc"), F.lit(True))
    return store.models.versions(MODEL_NAME).select(
        "version",
        param("train_rows").alias("train_rows"),
        param("test_rows").alias("test_rows"),
        metric("test_base_rate").alias("test_base_rate"),
        (F.col("promoted") == higher).alias("by_auc"),
    )
