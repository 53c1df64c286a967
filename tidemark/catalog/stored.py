"""Jobs that go through tables on disk: load, compute, publish, monitor, train, score."""

from __future__ import annotations

from datetime import UTC, date, datetime, timedelta
from functools import cache

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tidemark.catalog.base import (
    AS_OF,
    EVENT_DAYS,
    LONG_SQL,
    event_requests,
    query,
    work_folder,
)
from tidemark.plans.rolling import RollingStats, apply_late
from tidemark.sources.adapters import from_events, load
from tidemark.sources.registry import FeatureDefinition, FeatureView
from tidemark.catalog.monitoring import DISTRIBUTION_SQL, exploded_bins, psi_sql, quality_sql
from tidemark.plans.compute import backfill, compute_features
from tidemark.functions.time import iso_text
from tidemark.plans.historical import exploded_requests, historical_features
from tidemark.plans.jobs import apply_definitions
from tidemark.plans.modeling import MODEL_FEATURES, MODEL_NAME, MODEL_VIEW, train_and_register
from tidemark.plans.monitoring import monitor_features, monitor_status, stored_reference
from tidemark.plans.publish import (
    materialize,
    parity_differences,
    published_documents,
    published_wide,
)
from tidemark.plans.retraining import performance_check, retrain_reasons
from tidemark.plans.store import FeatureStore
from tidemark.plans.training import Label, build_training_set
from tidemark.streaming.scoring import score_and_log, score_stream

NEXT_3_DAYS = Label("purchase_next_3d", timedelta(days=3))
FIRST, LAST = date(2024, 1, 2), date(2024, 1, 30)


def _day(number: int) -> datetime:
    return datetime(2024, 1, number, tzinfo=UTC)


@cache
def events_store(spark: SparkSession, folder: str) -> FeatureStore:
    """A store of the events with all days computed; built once per session."""
    store = FeatureStore(spark, work_folder(spark))
    store.raw.replace_tables(from_events(spark, folder).present())
    apply_definitions(store)
    backfill(store, MODEL_VIEW, FIRST, LAST, now=AS_OF)
    return store


def own_store(spark: SparkSession, folder: str) -> FeatureStore:
    """A store like `events_store` for one query alone, which may write to it."""
    return events_store.__wrapped__(spark, folder)


def trained_store(spark: SparkSession, folder: str) -> FeatureStore:
    """A store of its own with a champion, trained on snapshots of the first half of the month."""
    store = own_store(spark, folder)
    days = [_day(number) for number in (5, 9, 13, 17)]
    frame = build_training_set(store, days, MODEL_FEATURES, NEXT_3_DAYS)
    train_and_register(store, frame, _day(17))
    materialize(store, MODEL_VIEW, AS_OF)
    return store


@query(
    f"""{EVENT_DAYS}, {LONG_SQL} SELECT 'user_purchase_stats' AS view_name, entity_id,
       feature_name, event_timestamp, round(value, 6) AS value FROM long"""
)
def stored_values(spark, folder):
    """Everything the backfill wrote, read again from the store."""
    return (
        events_store(spark, folder)
        .values.read()
        .select("view_name", "entity_id", "feature_name", "event_timestamp", "value")
    )


@query(
    f"""{EVENT_DAYS}, {LONG_SQL} SELECT 'user_purchase_stats' AS view_name, feature_name,
       count(*) AS n, CAST(0 AS BIGINT) AS rewritten
FROM long WHERE event_timestamp = TIMESTAMP '2024-01-20' GROUP BY feature_name"""
)
def recompute_writes_nothing(spark, folder):
    """One day computed again by its SQL: the same rows, and none written a second time."""
    store = own_store(spark, folder)
    again = compute_features(store, MODEL_VIEW, AS_OF)
    rows = store.values.snapshot(AS_OF, MODEL_VIEW).groupBy("view_name", "feature_name")
    return rows.agg(F.count(F.lit(1)).alias("n")).withColumn(
        "rewritten", F.lit(again).cast("bigint")
    )


@query(
    f"""{EVENT_DAYS}, req AS (SELECT event_id AS row_id, user_id AS entity_id,
       ts AS event_timestamp FROM events WHERE event_type = 'click')
SELECT req.row_id, req.entity_id, req.event_timestamp,
       CAST(view_count_7d AS DOUBLE) AS view_count_7d,
       round(avg_order_value_30d, 6) AS avg_order_value_30d
FROM req LEFT JOIN f ON f.entity_id = req.entity_id
     AND f.event_timestamp = date_trunc('day', req.event_timestamp)"""
)
def historical_features_stored(spark, folder):
    """Features of two days of validity at every click, out of the partitioned store."""
    store = events_store(spark, folder)
    clicks = event_requests(spark, folder, ["click"])
    return historical_features(store, clicks, ["view_count_7d", "avg_order_value_30d"])


@query(
    f"""{EVENT_DAYS} SELECT f.entity_id, f.event_timestamp,
       CAST(order_count_30d AS DOUBLE) AS order_count_30d,
       round(avg_order_value_30d, 6) AS avg_order_value_30d,
       round(days_since_last_order, 6) AS days_since_last_order,
       CAST(view_count_7d AS DOUBLE) AS view_count_7d,
       CAST(EXISTS (SELECT 1 FROM o WHERE o.user_id = f.entity_id
                    AND o.order_ts >= f.event_timestamp
                    AND o.order_ts < f.event_timestamp + INTERVAL 3 DAY) AS INTEGER) AS label
FROM f WHERE f.event_timestamp IN
     (TIMESTAMP '2024-01-05', TIMESTAMP '2024-01-12', TIMESTAMP '2024-01-19')"""
)
def training_set_stored(spark, folder):
    store = events_store(spark, folder)
    return build_training_set(store, [_day(5), _day(12), _day(19)], MODEL_FEATURES, NEXT_3_DAYS)


@query(
    f"""{EVENT_DAYS} SELECT f.entity_id, f.event_timestamp,
       CAST(order_count_30d AS DOUBLE) AS order_count_30d, CAST(1 AS INTEGER) AS label
FROM f WHERE f.event_timestamp IN (TIMESTAMP '2024-01-05', TIMESTAMP '2024-01-19')
     AND f.entity_id IN (SELECT user_id FROM o GROUP BY user_id HAVING count(*) > 1)"""
)
def training_set_sql_label(spark, folder):
    """A label as plain SQL that names no moment."""
    returning = "SELECT user_id AS entity_id, 1 AS label FROM orders GROUP BY 1 HAVING count(*) > 1"
    label = Label("returning", timedelta(days=3), returning)
    store = events_store(spark, folder)
    labels = build_training_set(store, [_day(5), _day(19)], ["order_count_30d"], label)
    # Users have no features before they signed up
    return labels.where(F.col("order_count_30d").isNotNull())


@query(
    f"""{EVENT_DAYS} SELECT entity_id, event_timestamp,
       CAST(order_count_30d AS DOUBLE) AS order_count_30d,
       round(avg_order_value_30d, 6) AS avg_order_value_30d,
       round(days_since_last_order, 6) AS days_since_last_order,
       CAST(view_count_7d AS DOUBLE) AS view_count_7d
FROM f WHERE event_timestamp = TIMESTAMP '2024-01-20'"""
)
def published_rows(spark, folder):
    store = own_store(spark, folder)
    materialize(store, MODEL_VIEW, AS_OF, force=True)
    return published_wide(store, MODEL_VIEW)


@query(
    f"""{EVENT_DAYS} SELECT count(*) AS entities, CAST(0 AS BIGINT) AS differences
FROM f WHERE event_timestamp = TIMESTAMP '2024-01-20'"""
)
def online_offline_parity(spark, folder):
    """Published values against the point-in-time join at the same moment."""
    store = own_store(spark, folder)
    entities = materialize(store, MODEL_VIEW, AS_OF, force=True)
    differences = parity_differences(store, MODEL_VIEW)
    return differences.agg(
        F.lit(entities).cast("bigint").alias("entities"),
        F.count(F.lit(1)).alias("differences"),
    )


_TRAINED_ON = """event_timestamp IN (TIMESTAMP '2024-01-05', TIMESTAMP '2024-01-09',
                                     TIMESTAMP '2024-01-13')"""
_MONITORED = "TIMESTAMP '2024-01-25'"
_DRIFT = psi_sql(_TRAINED_ON, f"event_timestamp = {_MONITORED}")
_REGISTERED = """
d AS (SELECT * FROM (VALUES ('order_count_30d', 0.0, NULL::DOUBLE, 0.01),
      ('avg_order_value_30d', 0.0, NULL, 1.0), ('days_since_last_order', 0.0, NULL, 1.0),
      ('view_count_7d', 0.0, NULL, 0.01)) t(feature_name, expected_min, expected_max, null_threshold))"""
_MONITORED_SQL = f"{quality_sql(_MONITORED, _REGISTERED)}, {_DRIFT}"


@query(
    f"""{EVENT_DAYS}, {LONG_SQL}, {_DRIFT}
SELECT name || ' has drifted: ' || message AS reason FROM drift WHERE status = 'alert'"""
)
def retrain_reasons_drift(spark, folder):
    """Which inputs of the model have drifted, as reasons to retrain."""
    reasons = retrain_reasons(trained_store(spark, folder), _day(25), NEXT_3_DAYS)
    drifted = [(reason,) for reason in reasons if " has drifted: " in reason]
    return spark.createDataFrame(drifted, "reason string")


@query(name="retrain_reasons")
def retrain_reasons_found(spark, folder):
    """All reasons to retrain the model: its inputs, its quality, or that there is none to check."""
    reasons = retrain_reasons(trained_store(spark, folder), _day(25), NEXT_3_DAYS)
    return spark.createDataFrame([(reason,) for reason in reasons], "reason string")


@query(
    f"""{EVENT_DAYS} SELECT 'purchase_model' AS name, 'roc_auc' AS metric, TRUE AS graded,
       ' on the snapshot of 2024-01-22' AS snapshot""",
    name="performance_check",
)
def champion_performance(spark, folder):
    """The check of the champion; `graded`: its status follows from both ROC AUCs."""
    store = trained_store(spark, folder)
    champion = store.models.champion(MODEL_NAME)
    found = performance_check(store, champion, _day(25), NEXT_3_DAYS)
    fell = F.lit(champion.test_roc_auc) - F.col("value") > 0.03
    return found.select(
        "name",
        "metric",
        (fell == (F.col("status") == "alert")).alias("graded"),
        F.regexp_extract("message", r"^ROC AUC [0-9.]+([^,]*)", 1).alias("snapshot"),
    )


@query(
    f"""{_MONITORED_SQL} SELECT name, metric, round(value, 6) AS value, status, message FROM checks
UNION ALL SELECT name, metric, round(value, 6), status, message FROM drift"""
)
def monitored_snapshot(spark, folder):
    return monitor_features(trained_store(spark, folder), MODEL_VIEW, _day(25))[0]


@query(
    f"""{_MONITORED_SQL},
every AS (SELECT name, status FROM checks UNION ALL SELECT name, status FROM drift
          UNION ALL SELECT feature_name, 'ok' FROM d),
code AS (SELECT name, count(*) AS n_checks, max(CASE status WHEN 'alert' THEN 2 WHEN 'warning' THEN 1
                ELSE 0 END) AS code FROM every GROUP BY name)
SELECT ['ok', 'warning', 'alert'][max(code) OVER () + 1] AS overall, name,
       ['ok', 'warning', 'alert'][code + 1] AS status, n_checks FROM code"""
)
def status_document(spark, folder):
    """The overall status with its checks per feature, one row per name."""
    store = trained_store(spark, folder)
    monitor_features(store, MODEL_VIEW, _day(25))
    document = monitor_status(store, _day(26))
    return document.select(
        F.col("status").alias("overall"), F.explode("features").alias("name", "summary")
    ).select(
        "overall", "name", "summary.status", F.size("summary.checks").cast("bigint").alias("n_checks")
    )


def _requests(spark, folder):
    events = spark.read.parquet(f"{folder}/events.parquet")
    return events.select(F.col("event_id").alias("row_id"), F.col("user_id").alias("entity_id"))


_SCORED_SQL = f"""{EVENT_DAYS} SELECT event_id AS row_id, user_id AS entity_id,
       f.event_timestamp AS features_as_of, CAST(order_count_30d AS DOUBLE) AS order_count_30d,
       round(avg_order_value_30d, 6) AS avg_order_value_30d,
       round(days_since_last_order, 6) AS days_since_last_order,
       CAST(view_count_7d AS DOUBLE) AS view_count_7d, TRUE AS scored
FROM events JOIN f ON f.entity_id = events.user_id
     AND f.event_timestamp = TIMESTAMP '2024-01-20'"""


def _logged(store, spark, folder, job):
    """What a job logged: the requests that were scored and the features that were used.

    The log has no request ids, so every logged row is set beside the requests of its entity.
    """
    logged = store.predictions.read().where(F.col("job") == job)
    per_entity = logged.groupBy("entity_id").agg(
        F.first("features_as_of").alias("features_as_of"),
        F.first(F.to_json("features")).alias("features"),
        F.count(F.lit(1)).alias("n_logged"),
        F.min(F.col("probability").between(0, 1)).alias("in_range"),
    )
    asked = _requests(spark, folder)
    n_asked = asked.groupBy("entity_id").agg(F.count(F.lit(1)).alias("n_asked"))
    values = F.from_json("features", "map<string,double>")
    return (
        asked.join(per_entity.join(n_asked, "entity_id"), "entity_id")
        .select(
            "row_id",
            "entity_id",
            "features_as_of",
            *[F.try_element_at(values, F.lit(name)).alias(name) for name in MODEL_FEATURES],
            (F.col("in_range") & (F.col("n_logged") == F.col("n_asked"))).alias("scored"),
        )
    )


@query(_SCORED_SQL)
def score_batch(spark, folder):
    """Every event as a scoring request."""
    store = trained_store(spark, folder)
    score_and_log(store, _requests(spark, folder), "batch", 0, AS_OF)
    return _logged(store, spark, folder, "batch")


@query(_SCORED_SQL, name="score_stream")
def score_as_stream(spark, folder):
    """The same requests read as a stream and logged batch by batch."""
    store = trained_store(spark, folder)
    source = f"{work_folder(spark)}/requests"
    _requests(spark, folder).write.parquet(source)
    schema = spark.read.parquet(source).schema
    requests = spark.readStream.schema(schema).parquet(source)
    score_stream(store, requests, "stream", f"{work_folder(spark)}/progress").awaitTermination()
    return _logged(store, spark, folder, "stream")


_ACTIVITY_SQL = """
SELECT u.user_id AS entity_id, s.as_of AS event_timestamp,
       count(o.order_id) AS orders_so_far, max(o.total_amount) AS largest_order
FROM snapshots s JOIN users u ON u.signup_ts < s.as_of
LEFT JOIN orders o ON o.user_id = u.user_id AND o.order_ts < s.as_of
GROUP BY u.user_id, s.as_of"""
_ACTIVITY = """
act AS (SELECT u.user_id AS entity_id, s.event_timestamp, count(o.order_id) AS orders_so_far,
               max(o.total_amount) AS largest_order
        FROM s JOIN u ON u.signup_ts < s.event_timestamp
        LEFT JOIN o ON o.user_id = u.user_id AND o.order_ts < s.event_timestamp
        GROUP BY ALL)"""


def _activity_store(spark, folder):
    """A store with a second view, computed for all days in one pass over `snapshots`."""
    store = own_store(spark, folder)
    ttl = timedelta(days=1)
    store.registry.apply(
        [FeatureView("activity", "user", ttl=ttl, source_sql=_ACTIVITY_SQL)],
        [FeatureDefinition(name, "activity") for name in ("orders_so_far", "largest_order")],
    )
    backfill(store, "activity", FIRST, LAST, now=AS_OF)
    return store


@query(
    f"""{EVENT_DAYS}, {_ACTIVITY} SELECT entity_id, event_timestamp, t.feature_name, t.value
FROM act, LATERAL (VALUES ('orders_so_far', CAST(orders_so_far AS DOUBLE)),
                          ('largest_order', CAST(largest_order AS DOUBLE))) t(feature_name, value)"""
)
def backfill_custom_view(spark, folder):
    """All days of a caller's own view, read again from the store."""
    return _activity_store(spark, folder).values.read("activity").select(
        "entity_id", "event_timestamp", "feature_name", "value"
    )


@query(
    f"""{EVENT_DAYS}, {_ACTIVITY}, req AS (SELECT event_id AS row_id, user_id AS entity_id,
       ts AS event_timestamp FROM events WHERE event_type = 'click')
SELECT req.row_id, req.entity_id, req.event_timestamp,
       CAST(act.largest_order AS DOUBLE) AS largest_order,
       CAST(f.view_count_7d AS DOUBLE) AS view_count_7d,
       CAST(act.orders_so_far AS DOUBLE) AS orders_so_far
FROM req LEFT JOIN f ON f.entity_id = req.entity_id
     AND f.event_timestamp = date_trunc('day', req.event_timestamp)
LEFT JOIN act ON act.entity_id = req.entity_id
     AND act.event_timestamp = date_trunc('day', req.event_timestamp)
     AND act.event_timestamp >= req.event_timestamp - INTERVAL 1 DAY"""
)
def historical_two_views(spark, folder):
    """Features of two views with validities of one and two days in one request."""
    store = _activity_store(spark, folder)
    clicks = event_requests(spark, folder, ["click"])
    names = ["largest_order", "view_count_7d", "orders_so_far"]
    return historical_features(store, clicks, names)


@query(
    f"""{EVENT_DAYS} SELECT attempt, written, TIMESTAMP '2024-01-20' AS until,
       (SELECT count(*) FROM f WHERE event_timestamp = TIMESTAMP '2024-01-20') AS entities
FROM (VALUES ('forward', TRUE), ('back', FALSE), ('again', TRUE)) t(attempt, written)"""
)
def published_forward_only(spark, folder):
    """Publishing a day, an earlier one, which is not written, and the same day again."""
    store = own_store(spark, folder)
    tried = [("forward", AS_OF), ("back", _day(12)), ("again", AS_OF)]
    rows = []
    for attempt, at in tried:
        written = materialize(store, MODEL_VIEW, at) is not None
        until = store.online.until(MODEL_VIEW)
        rows.append((attempt, written, until, store.online.read(MODEL_VIEW).count()))
    schema = "attempt string, written boolean, until timestamp, entities bigint"
    return spark.createDataFrame(rows, schema)


@query(
    f"""{EVENT_DAYS}, {LONG_SQL} SELECT entity_id, feature_name, event_timestamp, value FROM long
WHERE event_timestamp BETWEEN TIMESTAMP '2024-01-20' AND TIMESTAMP '2024-01-24'"""
)
def rolling_days(spark, folder):
    """Totals as of one midnight, carried on for four days that read one day of events each."""
    store = FeatureStore(spark, work_folder(spark))
    store.raw.replace_tables(from_events(spark, folder).present())
    apply_definitions(store)
    rolling = RollingStats(store)
    rolling.start(AS_OF.date(), now=AS_OF)
    for _ in range(4):
        rolling.advance(now=AS_OF)
    return store.values.read().select("entity_id", "feature_name", "event_timestamp", "value")


@query(
    f"""{EVENT_DAYS}, {LONG_SQL} SELECT entity_id, feature_name, event_timestamp, value FROM long"""
)
def late_events_mended(spark, folder):
    """Events of the last hour of each day come after everything was computed."""
    store = FeatureStore(spark, work_folder(spark))
    raw = from_events(spark, folder)
    late = {"orders": F.hour("order_ts") == 23, "product_views": F.hour("view_ts") == 23}
    tables = raw.present()
    in_time = {name: rows.where(~late[name]) if name in late else rows for name, rows in tables.items()}
    store.raw.replace_tables(in_time)
    apply_definitions(store)
    backfill(store, MODEL_VIEW, FIRST, LAST, now=AS_OF)
    load = store.raw.add_rows({name: tables[name].where(late[name]) for name in late})
    apply_late(store, load, now=AS_OF)
    return store.values.read().select("entity_id", "feature_name", "event_timestamp", "value")


_TOTALS_SQL = f"""{EVENT_DAYS},
moves AS (SELECT user_id AS entity_id, CAST(date_trunc('day', ts) AS TIMESTAMP) + INTERVAL 1 DAY
                 AS event_timestamp, event_type, max(value) AS value
          FROM events WHERE event_type IN ('click', 'purchase') GROUP BY ALL),
req AS (SELECT event_id AS row_id, user_id AS entity_id, ts AS event_timestamp FROM events
        WHERE event_type = 'view')"""


@query(
    f"""{_TOTALS_SQL} SELECT req.row_id, req.entity_id, req.event_timestamp,
       round(arg_max(m.value, m.event_timestamp) FILTER (WHERE m.event_type = 'click'), 6)
           AS click,
       round(arg_max(m.value, m.event_timestamp) FILTER (WHERE m.event_type = 'purchase'), 6)
           AS purchase
FROM req LEFT JOIN moves m ON m.entity_id = req.entity_id
     AND m.event_timestamp <= req.event_timestamp
GROUP BY ALL"""
)
def historical_without_ttl(spark, folder):
    """Values that never expire, by the default path: states of months and the days since.

    The greatest click and purchase of each user and day count from the next midnight on.
    """
    store = FeatureStore(spark, work_folder(spark))
    store.registry.apply(
        [FeatureView("greatest", "user")],
        [FeatureDefinition(name, "greatest") for name in ("click", "purchase")],
    )
    events = load(spark, folder, "events").where(F.col("event_type").isin("click", "purchase"))
    following = F.date_trunc("day", "ts") + F.expr("INTERVAL 1 DAY")
    values = events.groupBy(
        F.col("user_id").alias("entity_id"),
        following.alias("event_timestamp"),
        F.col("event_type").alias("feature_name"),
    ).agg(F.max("value").alias("value"))
    store.values.upsert(values.withColumn("view_name", F.lit("greatest")), now=AS_OF)
    store.values.advance_states("greatest", date(2024, 2, 1))
    return historical_features(
        store, event_requests(spark, folder, ["view"]), ["click", "purchase"]
    )


@query(
    f"""{EVENT_DAYS} SELECT user_id AS entity_id, strftime(ts, '%Y-%m-%dT%H:%M:%S+00:00') AS asked,
       CAST(view_count_7d AS DOUBLE) AS view_count_7d
FROM events LEFT JOIN f ON f.entity_id = user_id AND f.event_timestamp = date_trunc('day', ts)
WHERE event_type = 'click'"""
)
def historical_from_texts(spark, folder):
    """Requests as one list of users and one of ISO texts for each day."""
    clicks = event_requests(spark, folder, ["click"])
    whole = F.date_trunc("second", "event_timestamp")
    pairs = F.collect_list(F.struct("entity_id", iso_text(whole).alias("asked")))
    lists = clicks.groupBy(F.to_date("event_timestamp").alias("day")).agg(pairs.alias("pairs"))
    requests = exploded_requests(
        lists.select(
            F.col("pairs.entity_id").alias("entity_ids"), F.col("pairs.asked").alias("timestamps")
        )
    )
    found = historical_features(events_store(spark, folder), requests, ["view_count_7d"])
    return found.select("entity_id", iso_text(F.col("event_timestamp")).alias("asked"), "view_count_7d")


@query(
    f"""{EVENT_DAYS} SELECT entity_id, '2024-01-20T00:00:00+00:00' AS features_as_of,
       CAST(view_count_7d AS DOUBLE) AS view_count_7d
FROM f WHERE event_timestamp = TIMESTAMP '2024-01-20'"""
)
def published_texts(spark, folder):
    """Published rows as documents for other stores, one of their features read again."""
    store = own_store(spark, folder)
    materialize(store, MODEL_VIEW, AS_OF, force=True)
    return published_documents(store, MODEL_VIEW).select(
        "entity_id",
        "features_as_of",
        F.get_json_object("document", "$.view_count_7d").cast("double").alias("view_count_7d"),
    )


@query(DISTRIBUTION_SQL)
def drift_reference_stored(spark, folder):
    """A reference over a month, added up from the counts of its days."""
    store = own_store(spark, folder)
    return exploded_bins(stored_reference(store, MODEL_VIEW, FIRST, LAST))
