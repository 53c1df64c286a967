"""Features, labels, snapshots and raw-table checks."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from tidemark.catalog.base import (
    AS_OF,
    DAYS,
    EVENT_DAYS,
    DAYS_SQL,
    EVENTS_SQL,
    FEATURES_SQL,
    LONG_SQL,
    MOMENT_SQL,
    MONTHS,
    MONTHS_SQL,
    STATS_SQL,
    TRADE_MONTHS,
    TRADE_SQL,
    query,
)
from tidemark.functions.time import midnight
from tidemark.sources.adapters import from_events, from_trade
from tidemark.operators.integrity import commerce_checks
from tidemark.operators.labels import bought_within, buyers
from tidemark.operators.reshape import to_long, to_wide
from tidemark.operators.upsert import merge_values
from tidemark.plans.compute import sql_at
from tidemark.plans.purchase_stats import FEATURES, SQL, VIEW, purchase_stats, purchase_stats_at

_ONE_MOMENT = f"""WITH {EVENTS_SQL}, {MOMENT_SQL}, {STATS_SQL}
SELECT entity_id, {FEATURES_SQL} FROM f"""


@query(_ONE_MOMENT)
def purchase_stats_asof(spark, folder):
    return purchase_stats(from_events(spark, folder), AS_OF)


@query(_ONE_MOMENT)
def purchase_stats_sql_view(spark, folder):
    return sql_at(from_events(spark, folder), SQL, [AS_OF]).drop("event_timestamp")


@query(
    f"""WITH {TRADE_SQL}, s AS (SELECT TIMESTAMP '1999-06-15 12:00:00' AS event_timestamp),
{STATS_SQL} SELECT entity_id, {FEATURES_SQL} FROM f"""
)
def purchase_stats_at_noon(spark, folder):
    return purchase_stats(
        from_trade(spark, folder), AS_OF.replace(year=1999, month=6, day=15, hour=12)
    )


@query(
    f"""WITH {EVENTS_SQL}, {MOMENT_SQL}, {STATS_SQL}, {LONG_SQL}
SELECT entity_id, feature_name, round(value, 6) AS value FROM long"""
)
def feature_values_unpivot(spark, folder):
    return to_long(purchase_stats(from_events(spark, folder), AS_OF), FEATURES, ["entity_id"])


@query(
    f"""{EVENT_DAYS} SELECT entity_id, event_timestamp,
       CAST(order_count_30d AS DOUBLE) AS order_count_30d,
       round(avg_order_value_30d, 6) AS avg_order_value_30d,
       round(days_since_last_order, 6) AS days_since_last_order,
       CAST(view_count_7d AS DOUBLE) AS view_count_7d FROM f"""
)
def feature_values_pivot(spark, folder):
    keys = ["entity_id", "event_timestamp"]
    wide = purchase_stats_at(from_events(spark, folder), DAYS)
    return to_wide(to_long(wide, FEATURES, keys), FEATURES, keys)


@query(f"{EVENT_DAYS} SELECT entity_id, event_timestamp, {FEATURES_SQL} FROM f")
def backfill_daily(spark, folder):
    return purchase_stats_at(from_events(spark, folder), DAYS)


@query(f"{EVENT_DAYS} SELECT entity_id, event_timestamp, {FEATURES_SQL} FROM f")
def backfill_sql_parameter(spark, folder):
    """SQL with the parameter `as_of`, for all days in one lateral pass."""
    return sql_at(from_events(spark, folder), SQL, DAYS)


@query(
    f"""WITH {EVENTS_SQL}, {DAYS_SQL} SELECT o.user_id AS entity_id, s.event_timestamp,
       count(*) AS orders_so_far, max(o.total_amount)::DOUBLE AS greatest
FROM s JOIN o ON o.order_ts < s.event_timestamp GROUP BY ALL"""
)
def backfill_sql_snapshots(spark, folder):
    """SQL over the table of moments."""
    sql = """SELECT user_id AS entity_id, as_of AS event_timestamp, count(*) AS orders_so_far,
                    CAST(max(total_amount) AS DOUBLE) AS greatest
             FROM snapshots JOIN orders ON order_ts < as_of GROUP BY ALL"""
    return sql_at(from_events(spark, folder), sql, DAYS)


@query(
    f"""WITH {EVENTS_SQL}, {DAYS_SQL} SELECT o.user_id AS entity_id, s.event_timestamp,
       count(*) AS orders_ever FROM s, o GROUP BY ALL"""
)
def backfill_sql_constant(spark, folder):
    """SQL that names no moment is the same at each."""
    sql = "SELECT user_id AS entity_id, count(*) AS orders_ever FROM orders GROUP BY ALL -- :as_of"
    return sql_at(from_events(spark, folder), sql, DAYS)


@query(f"{TRADE_MONTHS} SELECT entity_id, event_timestamp, {FEATURES_SQL} FROM f")
def purchase_stats_monthly(spark, folder):
    return purchase_stats_at(from_trade(spark, folder), MONTHS)


@query(
    f"""WITH {TRADE_SQL}, {MONTHS_SQL}
SELECT u.user_id AS entity_id, s.event_timestamp,
       CAST(EXISTS (SELECT 1 FROM o WHERE o.user_id = u.user_id
                    AND o.order_ts >= s.event_timestamp
                    AND o.order_ts < s.event_timestamp + INTERVAL 30 DAY) AS INTEGER) AS label
FROM u JOIN s ON u.signup_ts < s.event_timestamp"""
)
def labels_next_window(spark, folder):
    commerce = from_trade(spark, folder)
    return bought_within(commerce.users, commerce.orders, MONTHS, timedelta(days=30))


@query(
    """SELECT DISTINCT user_id AS entity_id FROM events
WHERE event_type = 'purchase' AND ts >= TIMESTAMP '2024-01-20' AND ts < TIMESTAMP '2024-01-25'"""
)
def buyers_in_window(spark, folder):
    return buyers(from_events(spark, folder).orders, AS_OF, timedelta(days=5))


@query(
    f"""WITH {EVENTS_SQL}, {MONTHS_SQL.replace("1995-02-01", "2024-01-02").replace(
        "2001-07-01", "2024-01-30").replace("1 MONTH", "1 DAY")}, {STATS_SQL}, {LONG_SQL},
new AS (SELECT * FROM long WHERE event_timestamp >= TIMESTAMP '2024-01-10'),
oo AS (SELECT * FROM o WHERE total_amount <= 100),
old_o AS (SELECT u.user_id, s.event_timestamp,
              count(*) FILTER (WHERE oo.order_ts >= s.event_timestamp - INTERVAL 30 DAY) AS n,
              sum(oo.total_amount)
                  FILTER (WHERE oo.order_ts >= s.event_timestamp - INTERVAL 30 DAY) AS amount,
              max(oo.order_ts) AS last_ts
       FROM u JOIN s ON u.signup_ts < s.event_timestamp
              JOIN oo ON oo.user_id = u.user_id AND oo.order_ts < s.event_timestamp GROUP BY ALL),
old_f AS (SELECT f.entity_id, f.event_timestamp, coalesce(old_o.n, 0) AS order_count_30d,
             CAST(old_o.amount AS DOUBLE) / nullif(old_o.n, 0) AS avg_order_value_30d,
             (epoch_us(f.event_timestamp) - epoch_us(old_o.last_ts)) / 86400000000.0
                 AS days_since_last_order, f.view_count_7d
          FROM f LEFT JOIN old_o ON old_o.user_id = f.entity_id
               AND old_o.event_timestamp = f.event_timestamp
          WHERE f.event_timestamp <= TIMESTAMP '2024-01-20'),
{LONG_SQL.replace("long AS", "old AS").replace("FROM f,", "FROM old_f,")}
SELECT CASE WHEN old.entity_id IS NULL THEN 'inserted' WHEN new.entity_id IS NULL THEN 'kept'
            WHEN old.value IS NOT DISTINCT FROM new.value THEN 'unchanged' ELSE 'changed' END
           AS change,
       coalesce(old.feature_name, new.feature_name) AS feature_name, count(*) AS n
FROM old FULL JOIN new ON old.entity_id = new.entity_id AND old.feature_name = new.feature_name
     AND old.event_timestamp = new.event_timestamp
GROUP BY ALL"""
)
def upsert_changes(spark, folder):
    """Stored without the orders above 100, which arrive late, and computed again with them."""
    commerce = from_events(spark, folder)
    before = type(commerce)(
        commerce.users, commerce.orders.where("total_amount <= 100"), commerce.product_views
    )
    keys = ["entity_id", "event_timestamp"]

    def values(source, snapshots):
        wide = purchase_stats_at(source, snapshots)
        return to_long(wide, FEATURES, keys).withColumn("view_name", F.lit(VIEW))

    stored = values(before, [day for day in DAYS if day <= AS_OF])
    stored = stored.withColumn("created_at", F.lit(AS_OF))
    new = values(commerce, [day for day in DAYS if day >= midnight(AS_OF.replace(day=10).date())])
    merged = merge_values(stored, new, AS_OF)
    return merged.groupBy("change", "feature_name").agg(F.count(F.lit(1)).alias("n"))


_UNIQUE = """SELECT '{table}' AS name, 'primary_key' AS metric,
       CAST(coalesce(sum(c - 1), 0) AS DOUBLE) AS value FROM
       (SELECT count(*) AS c FROM {source} GROUP BY {keys})"""
_PARENT = """SELECT '{table}' AS name, 'foreign_key_{column}' AS metric,
       CAST(count(*) AS DOUBLE) AS value FROM {source}
       WHERE {column} IS NOT NULL AND {column} NOT IN (SELECT {parent_column} FROM {parent})"""
_RULE = """SELECT '{table}' AS name, '{metric}' AS metric,
       CAST(count(*) FILTER (WHERE NOT ({rule})) AS DOUBLE) AS value FROM {source}"""


def _checks_sql() -> str:
    parts = []
    columns = {
        "users": ["user_id", "signup_ts"],
        "orders": ["order_id", "user_id", "order_ts", "total_amount"],
        "product_views": ["view_id", "user_id", "product_id", "view_ts"],
        "products": ["product_id", "category", "price"],
        "order_items": ["order_id", "product_id", "quantity", "unit_price"],
    }
    keys = {
        "users": "user_id",
        "orders": "order_id",
        "product_views": "view_id",
        "products": "product_id",
        "order_items": "order_id, product_id",
    }
    source = {name: f"raw_{name}" for name in columns}
    for table, names in columns.items():
        parts.append(_UNIQUE.format(table=table, source=source[table], keys=keys[table]))
        for name in names:
            parts.append(
                _RULE.format(
                    table=table,
                    source=source[table],
                    metric=f"not_null_{name}",
                    rule=f"{name} IS NOT NULL",
                )
            )
    parents = [
        ("orders", "user_id", "users"),
        ("product_views", "user_id", "users"),
        ("product_views", "product_id", "products"),
        ("order_items", "order_id", "orders"),
        ("order_items", "product_id", "products"),
    ]
    for table, column, parent in parents:
        parts.append(
            _PARENT.format(
                table=table,
                source=source[table],
                column=column,
                parent=source[parent],
                parent_column=column,
            )
        )
    parts.append(
        _RULE.format(
            table="order_items",
            source="raw_order_items",
            metric="check_quantity",
            rule="quantity > 0",
        )
    )
    parts.append(
        """SELECT 'orders' AS name, 'item_totals' AS metric,
       CAST(count(*) FILTER (WHERE total IS DISTINCT FROM lines) AS DOUBLE) AS value FROM
       (SELECT order_id, max(total_amount) AS total FROM raw_orders GROUP BY order_id)
       LEFT JOIN (SELECT order_id, sum(unit_price * quantity) AS lines FROM raw_order_items
                  GROUP BY order_id) USING (order_id)"""
    )
    return f"""WITH {TRADE_SQL}, raw_users AS (SELECT * FROM u), raw_orders AS (SELECT * FROM o),
raw_product_views AS (SELECT l_orderkey AS view_id, o_custkey AS user_id, l_partkey AS product_id,
                             l_shipdate AS view_ts
                      FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
raw_products AS (SELECT p_partkey AS product_id, p_type AS category,
                        CAST(p_retailprice AS DECIMAL(10,2)) AS price FROM part),
raw_order_items AS (SELECT l_orderkey AS order_id, l_partkey AS product_id,
                           CAST(l_quantity AS INTEGER) AS quantity,
                           CAST(l_extendedprice / l_quantity AS DECIMAL(10,2)) AS unit_price
                    FROM lineitem),
checks AS ({" UNION ALL ".join(parts)})
SELECT name, metric, value, CASE WHEN value > 0 THEN 'alert' ELSE 'ok' END AS status FROM checks"""


@query(_checks_sql())
def integrity_checks(spark, folder):
    return commerce_checks(from_trade(spark, folder)).drop("message")
