"""Point-in-time joins, latest values, enrichment and training sets."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from tidemark.catalog.base import (
    AS_OF,
    EVENT_DAYS,
    LONG_SQL,
    MONTHS,
    TRADE_MONTHS,
    daily_rows,
    daily_values,
    event_requests,
    observations,
    query,
)
from tidemark.functions.time import midnight
from tidemark.operators.asof import asof_join
from tidemark.operators.explore import (
    describe, label_rate_by_snapshot, means_by_label, missing_share,
)
from tidemark.operators.labels import bought_within
from tidemark.operators.latest import latest_rows, latest_values, without_nulls
from tidemark.plans.historical import features_at
from tidemark.plans.publish import stale_entities
from tidemark.plans.purchase_stats import FEATURES
from tidemark.session import cut
from tidemark.sources.adapters import from_events, from_trade, load
from tidemark.sources.online import read_entities, read_features

STORED = ["purchase", "view", "click"]
ASKED = ["signup", "error"]
TWO_DAYS = timedelta(days=2)

_VALUES_SQL = """
val AS (SELECT event_type AS feature_name, user_id AS entity_id, ts AS event_timestamp,
               CASE WHEN value <= 100 THEN value END AS value
        FROM events WHERE event_type IN ('purchase', 'view', 'click')),
req AS (SELECT event_id AS row_id, user_id AS entity_id, ts AS event_timestamp
        FROM events WHERE event_type IN ('signup', 'error'))"""


def _looked_up(feature: str, ttl: str | None) -> str:
    """One feature of every request by DuckDB's own as-of join."""
    value = f"CASE WHEN val.event_timestamp >= req.event_timestamp - INTERVAL {ttl} THEN value END"
    return f"""(SELECT req.row_id, {value if ttl else 'value'} AS value FROM req
        ASOF LEFT JOIN (SELECT * FROM val WHERE feature_name = '{feature}') val
        ON req.entity_id = val.entity_id AND req.event_timestamp >= val.event_timestamp)"""


def _pit_sql(ttls: dict[str, str | None], source: str = _VALUES_SQL) -> str:
    joins = "".join(
        f" JOIN {_looked_up(name, ttl)} AS j_{name} USING (row_id)" for name, ttl in ttls.items()
    )
    columns = ", ".join(f"round(j_{name}.value, 6) AS {name}" for name in ttls)
    return f"WITH {source} SELECT row_id, entity_id, event_timestamp, {columns} FROM req{joins}"


@query(_pit_sql({"purchase": "2 DAY", "view": None, "click": "1 HOUR"}))
def pit_join(spark, folder):
    ttls = {"purchase": TWO_DAYS, "view": None, "click": timedelta(hours=1)}
    return asof_join(
        event_requests(spark, folder, ASKED), observations(spark, folder, STORED), ttls
    )


@query(_pit_sql({"purchase": "2 DAY"}))
def pit_join_ttl(spark, folder):
    return asof_join(
        event_requests(spark, folder, ASKED),
        observations(spark, folder, STORED),
        {"purchase": TWO_DAYS},
    )


@query(_pit_sql({"purchase": None}))
def pit_join_no_ttl(spark, folder):
    return asof_join(
        event_requests(spark, folder, ASKED),
        observations(spark, folder, STORED),
        {"purchase": None},
    )


@query(
    f"""WITH {_VALUES_SQL}, ranked AS (
SELECT req.row_id, val.value, val.event_timestamp AS seen_at,
       row_number() OVER (PARTITION BY req.row_id ORDER BY val.event_timestamp DESC) AS place
FROM req JOIN val ON val.entity_id = req.entity_id AND val.feature_name = 'purchase'
     AND val.event_timestamp <= req.event_timestamp)
SELECT count(*) AS answered, count(*) FILTER (WHERE value IS NULL) AS stored_null
FROM ranked WHERE place = 1"""
)
def pit_join_null_wins(spark, folder):
    """Requests that see a stored null: it is not skipped in favour of an older value."""
    values = observations(spark, folder, STORED)
    marks = values.withColumn("feature_name", F.lit("seen")).withColumn("value", F.lit(1.0))
    purchases = values.where("feature_name = 'purchase'")
    both = purchases.unionByName(marks.where(values["feature_name"] == "purchase"))
    answers = asof_join(
        event_requests(spark, folder, ASKED), both, {"purchase": None, "seen": None}
    ).where("seen IS NOT NULL")
    return answers.agg(
        F.count(F.lit(1)).alias("answered"),
        F.count_if(F.col("purchase").isNull()).alias("stored_null"),
    )


@query(_pit_sql({"purchase": "2 DAY", "view": None, "click": "1 HOUR"}))
def pit_join_split_entities(spark, folder):
    """The same join, entities with more than 1/150 of all rows cut into slices of their time."""
    ttls = {"purchase": TWO_DAYS, "view": None, "click": timedelta(hours=1)}
    return asof_join(
        event_requests(spark, folder, ASKED),
        observations(spark, folder, STORED),
        ttls,
        hot_rows=load(spark, folder, "events").count() // 150,
    )


@query(
    """WITH val AS (SELECT o_custkey AS entity_id, o_orderdate AS event_timestamp,
               max_by(o_totalprice, o_orderkey) AS value FROM orders GROUP BY ALL),
req AS (SELECT l_orderkey AS row_id, o_custkey AS entity_id, l_shipdate AS event_timestamp
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT req.row_id, req.entity_id, req.event_timestamp,
       CASE WHEN val.event_timestamp >= req.event_timestamp - INTERVAL 365 DAY
            THEN round(value, 6) END AS order_price
FROM req ASOF LEFT JOIN val
     ON req.entity_id = val.entity_id AND req.event_timestamp >= val.event_timestamp"""
)
def pit_join_shipments(spark, folder):
    """The customer's newest order price at every shipment, not older than a year."""
    commerce = from_trade(spark, folder)
    prices = commerce.orders.groupBy(
        F.col("user_id").alias("entity_id"), F.col("order_ts").alias("event_timestamp")
    ).agg(F.max_by("total_amount", "order_id").cast("double").alias("value"))
    requests = commerce.product_views.select(
        F.col("view_id").alias("row_id"),
        F.col("user_id").alias("entity_id"),
        F.col("view_ts").alias("event_timestamp"),
    )
    values = prices.withColumn("feature_name", F.lit("order_price"))
    return asof_join(requests, values, {"order_price": timedelta(days=365)})


@query(
    f"""{EVENT_DAYS}, req AS (SELECT event_id AS row_id, user_id AS entity_id,
       ts AS event_timestamp FROM events WHERE event_type IN ('signup', 'error'))
SELECT req.row_id, req.entity_id, req.event_timestamp, CAST(order_count_30d AS DOUBLE)
       AS order_count_30d, round(avg_order_value_30d, 6) AS avg_order_value_30d,
       round(days_since_last_order, 6) AS days_since_last_order,
       CAST(view_count_7d AS DOUBLE) AS view_count_7d
FROM req LEFT JOIN f ON f.entity_id = req.entity_id
     AND f.event_timestamp = date_trunc('day', req.event_timestamp)"""
)
def pit_join_daily_values(spark, folder):
    """Daily stored values, pruned to the days and entities of the requests before the join."""
    requests = event_requests(spark, folder, ASKED)
    values = cut(daily_values(from_events(spark, folder)))
    return features_at(requests, values, dict.fromkeys(FEATURES, TWO_DAYS))


_LABELS = """, labels AS (SELECT u.user_id AS entity_id, s.event_timestamp,
       CAST(EXISTS (SELECT 1 FROM o WHERE o.user_id = u.user_id
                    AND o.order_ts >= s.event_timestamp
                    AND o.order_ts < s.event_timestamp + INTERVAL 30 DAY) AS INTEGER) AS label
       FROM u JOIN s ON u.signup_ts < s.event_timestamp),
t AS (SELECT f.*, labels.label FROM labels JOIN f USING (entity_id, event_timestamp))"""
TRAINING_SQL = TRADE_MONTHS + _LABELS


def training_frame(spark, folder):
    """Labels at monthly snapshots, joined with the values stored for those months."""
    commerce = from_trade(spark, folder)
    labels = bought_within(commerce.users, commerce.orders, MONTHS, timedelta(days=30))
    values = daily_rows(commerce, MONTHS)
    ttls = dict.fromkeys(FEATURES, TWO_DAYS)
    return asof_join(labels, values, ttls, hot_rows=None).select(
        "entity_id", "event_timestamp", *FEATURES, "label"
    )


@query(
    f"""{TRAINING_SQL} SELECT entity_id, event_timestamp,
       CAST(order_count_30d AS DOUBLE) AS order_count_30d,
       round(avg_order_value_30d, 6) AS avg_order_value_30d,
       round(days_since_last_order, 6) AS days_since_last_order,
       CAST(view_count_7d AS DOUBLE) AS view_count_7d, label FROM t"""
)
def training_set(spark, folder):
    return training_frame(spark, folder)


@query(
    f"""{TRAINING_SQL} SELECT event_timestamp, round(avg(label), 6) AS label_rate
FROM t GROUP BY ROLLUP (event_timestamp)""",
    name="label_rate_by_snapshot",
)
def label_rates(spark, folder):
    return label_rate_by_snapshot(training_frame(spark, folder))


@query(
    f"""{TRAINING_SQL}, m AS (SELECT avg(CAST(order_count_30d IS NULL AS INT)) AS a,
       avg(CAST(avg_order_value_30d IS NULL AS INT)) AS b,
       avg(CAST(days_since_last_order IS NULL AS INT)) AS c,
       avg(CAST(view_count_7d IS NULL AS INT)) AS d FROM t)
SELECT x.column_name, round(x.missing_share, 6) AS missing_share FROM m, LATERAL (VALUES
       ('order_count_30d', a), ('avg_order_value_30d', b), ('days_since_last_order', c),
       ('view_count_7d', d)) x(column_name, missing_share)""",
    name="missing_share",
)
def missing_shares(spark, folder):
    return missing_share(training_frame(spark, folder), FEATURES)


@query(
    f"""{TRAINING_SQL} SELECT label, round(avg(order_count_30d), 6) AS order_count_30d,
       round(avg(avg_order_value_30d), 6) AS avg_order_value_30d,
       round(avg(days_since_last_order), 6) AS days_since_last_order,
       round(avg(view_count_7d), 6) AS view_count_7d FROM t GROUP BY label""",
    name="means_by_label",
)
def means_per_label(spark, folder):
    return means_by_label(training_frame(spark, folder), FEATURES)


@query(
    f"""{TRADE_MONTHS}, {LONG_SQL}
SELECT feature_name AS column_name, count(value) AS count, round(avg(value), 6) AS mean,
       round(stddev_samp(value), 6) AS std, round(min(value), 6) AS min,
       round(quantile_cont(value, 0.25), 6) AS q25, round(quantile_cont(value, 0.5), 6) AS q50,
       round(quantile_cont(value, 0.75), 6) AS q75, round(max(value), 6) AS max
FROM long GROUP BY feature_name""",
    name="describe",
)
def describe_features(spark, folder):
    return describe(training_frame(spark, folder), FEATURES)


@query(
    """SELECT user_id AS entity_id, event_type AS feature_name, max(ts) AS event_timestamp,
       round(arg_max_null(CASE WHEN value <= 100 THEN value END, ts), 6) AS value FROM events
WHERE event_type IN ('purchase', 'view', 'click') AND ts <= TIMESTAMP '2024-01-20'
      AND ts >= TIMESTAMP '2024-01-18' GROUP BY ALL""",
    name="latest_values",
)
def latest_per_feature(spark, folder):
    return latest_values(observations(spark, folder, STORED), AS_OF, TWO_DAYS)


_LATEST_SQL = """
l AS (SELECT user_id AS entity_id, event_type AS feature_name, max(ts) AS event_timestamp,
             arg_max_null(CASE WHEN value <= 100 THEN value END, ts) AS value FROM events
      WHERE event_type IN ('purchase', 'view', 'click') AND ts <= TIMESTAMP '2024-01-20'
            AND ts >= TIMESTAMP '2024-01-18' GROUP BY ALL),
w AS (SELECT entity_id, max(event_timestamp) AS event_timestamp, count(value) AS n_values,
             max(value) FILTER (WHERE feature_name = 'purchase') AS purchase,
             max(value) FILTER (WHERE feature_name = 'view') AS view,
             max(value) FILTER (WHERE feature_name = 'click') AS click
      FROM l GROUP BY entity_id)"""


def _published(spark, folder, as_of=AS_OF, ttl=TWO_DAYS):
    rows = latest_rows(observations(spark, folder, STORED), as_of, ttl, STORED)
    return without_nulls(rows)


@query(
    f"""WITH {_LATEST_SQL} SELECT entity_id, event_timestamp, n_values,
       round(purchase, 6) AS purchase, round(view, 6) AS view, round(click, 6) AS click FROM w""",
    name="latest_values_map",
)
def latest_per_entity(spark, folder):
    """The published row of each entity: a map without the null features."""
    return _published(spark, folder).select(
        "entity_id",
        "event_timestamp",
        F.size("values").cast("bigint").alias("n_values"),
        *[F.try_element_at("values", F.lit(name)).alias(name) for name in STORED],
    )


@query(
    """SELECT DISTINCT user_id AS entity_id FROM events
WHERE event_type IN ('purchase', 'view', 'click')
      AND ts <= TIMESTAMP '2024-01-10' AND ts >= TIMESTAMP '2024-01-09'
      AND user_id NOT IN (SELECT user_id FROM events
                          WHERE event_type IN ('purchase', 'view', 'click')
                                AND ts <= TIMESTAMP '2024-01-20'
                                AND ts >= TIMESTAMP '2024-01-19')"""
)
def published_stale_entities(spark, folder):
    day = timedelta(days=1)
    before = _published(spark, folder, midnight(AS_OF.replace(day=10).date()), day)
    return stale_entities(before, _published(spark, folder, AS_OF, day))


@query(
    f"""WITH {_LATEST_SQL} SELECT e.event_id AS row_id, e.user_id AS entity_id,
       w.event_timestamp AS features_as_of, w.entity_id IS NOT NULL AS found,
       CAST(coalesce(w.n_values, 0) AS BIGINT) AS n_values
FROM events e LEFT JOIN w ON w.entity_id = e.user_id"""
)
def online_enrich(spark, folder):
    """Every event with whatever is published for its user."""
    events = load(spark, folder, "events")
    requests = events.select(
        F.col("event_id").alias("row_id"), F.col("user_id").alias("entity_id")
    )
    enriched = read_entities(requests, _published(spark, folder))
    return enriched.select(
        "row_id",
        "entity_id",
        "features_as_of",
        "found",
        F.coalesce(F.size("values"), F.lit(0)).cast("bigint").alias("n_values"),
    )


@query(
    f"""WITH {_LATEST_SQL} SELECT e.event_id AS row_id, e.user_id AS entity_id,
       w.entity_id IS NOT NULL AS found, w.event_timestamp AS features_as_of,
       round(w.click, 6) AS click, round(w.purchase, 6) AS purchase
FROM events e LEFT JOIN w ON w.entity_id = e.user_id"""
)
def online_enrich_features(spark, folder):
    """Every event with two requested features, users with 1/150 of all events joined apart."""
    events = load(spark, folder, "events")
    requests = events.select(
        F.col("event_id").alias("row_id"), F.col("user_id").alias("entity_id")
    )
    published = cut(_published(spark, folder))
    return read_features(requests, published, ["click", "purchase"], events.count() // 150)

