"""Quality, freshness, drift, the check log and its status."""

from __future__ import annotations

from datetime import timedelta
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.catalog.base import (
    AS_OF,
    EVENT_DAYS,
    LONG_SQL,
    MONTHS,
    TRADE_MONTHS,
    daily_values,
    observations,
    query,
)
from tidemark.functions.time import midnight
from tidemark.sources.adapters import from_events, from_trade
from tidemark.operators.drift import (
    drift_checks, reference_distribution, stability_index, value_counts,
)
from tidemark.operators.freshness import freshness_checks
from tidemark.operators.quality import problems, quality_checks
from tidemark.operators.status import latest_outcomes, overall_status, status_by_name
from tidemark.plans.purchase_stats import VIEW
from tidemark.session import cut
from tidemark.sources.registry import FeatureDefinition, definitions_frame

# Thresholds that some snapshots break.
DEFINITIONS = [
    FeatureDefinition("order_count_30d", VIEW, expected_min=1, expected_max=40),
    FeatureDefinition("avg_order_value_30d", VIEW, expected_min=0.5, null_threshold=0.001),
    FeatureDefinition("days_since_last_order", VIEW, expected_min=0, expected_max=20.25),
    FeatureDefinition("view_count_7d", VIEW, expected_min=0),
    FeatureDefinition("sessions_7d", VIEW, expected_min=0),
]
_DEFINITIONS_SQL = """
d AS (SELECT * FROM (VALUES ('order_count_30d', 1.0, 40.0, 0.01),
      ('avg_order_value_30d', 0.5, NULL, 0.001), ('days_since_last_order', 0.0, 20.25, 0.01),
      ('view_count_7d', 0.0, NULL, 0.01), ('sessions_7d', 0.0, NULL, 0.01))
      t(feature_name, expected_min, expected_max, null_threshold))"""


def quality_sql(snapshots: str, definitions: str = _DEFINITIONS_SQL) -> str:
    return f"""{EVENT_DAYS}, {LONG_SQL}, {definitions},
days AS (SELECT event_timestamp FROM s WHERE event_timestamp IN ({snapshots})),
q AS (SELECT feature_name, event_timestamp, count(*) AS n, avg(CAST(value IS NULL AS INT)) AS nulls,
             min(value) AS low, max(value) AS high FROM long GROUP BY ALL),
j AS (SELECT d.*, days.event_timestamp, coalesce(n, 0) AS n, nulls, low, high
      FROM d CROSS JOIN days LEFT JOIN q USING (feature_name, event_timestamp)),
checks AS (
SELECT event_timestamp, feature_name AS name, 'row_count' AS metric, CAST(n AS DOUBLE) AS value,
       CASE WHEN n = 0 THEN 'alert' ELSE 'ok' END AS status,
       CASE WHEN n = 0
            THEN 'no values for ' || strftime(event_timestamp, '%Y-%m-%dT%H:%M:%S+00:00')
            ELSE format('{{:,}} values', n) END AS message FROM j
UNION ALL SELECT event_timestamp, feature_name, 'null_share', nulls,
       CASE WHEN nulls > null_threshold THEN 'alert' ELSE 'ok' END,
       format('{{:.1f}}% of values are null, allowed {{:.1f}}%', nulls * 100,
              CAST(null_threshold * 100 AS DOUBLE)) FROM j WHERE n > 0
UNION ALL SELECT event_timestamp, feature_name, 'minimum', low,
       CASE WHEN low < expected_min THEN 'alert' ELSE 'ok' END,
       format('minimum {{:g}}', low)
       || CASE WHEN low < expected_min THEN ' is below the expected '
               ELSE ', expected at least ' END || format('{{:g}}', CAST(expected_min AS DOUBLE))
       FROM j WHERE low IS NOT NULL AND expected_min IS NOT NULL
UNION ALL SELECT event_timestamp, feature_name, 'maximum', high,
       CASE WHEN high > expected_max THEN 'alert' ELSE 'ok' END,
       format('maximum {{:g}}', high)
       || CASE WHEN high > expected_max THEN ' is above the expected '
               ELSE ', expected at most ' END || format('{{:g}}', CAST(expected_max AS DOUBLE))
       FROM j WHERE high IS NOT NULL AND expected_max IS NOT NULL)"""


def _snapshot_checks(spark, folder, as_of=AS_OF):
    values = daily_values(from_events(spark, folder), [as_of])
    return quality_checks(definitions_frame(spark, DEFINITIONS), values, as_of)


@query(
    f"""{quality_sql("TIMESTAMP '2024-01-20'")}
SELECT name, metric, round(value, 6) AS value, status, message FROM checks""",
    name="quality_checks",
)
def snapshot_quality_checks(spark, folder):
    return _snapshot_checks(spark, folder)


@query(
    f"""{quality_sql("TIMESTAMP '2024-01-20'")}
SELECT name || ': ' || message AS problem FROM checks WHERE status = 'alert'""",
    name="quality_problems",
)
def snapshot_problems(spark, folder):
    return problems(_snapshot_checks(spark, folder))


_FRESH = [
    FeatureDefinition("purchase", VIEW, freshness_hours=1),
    FeatureDefinition("view", VIEW, freshness_hours=24),
    FeatureDefinition("click", VIEW, freshness_hours=0),
    FeatureDefinition("refund", VIEW),
]


@query(
    """WITH d(name, allowed) AS (VALUES ('purchase', 1), ('view', 24), ('click', 0), ('refund', 24)),
a AS (SELECT d.name, allowed,
             (epoch_us(TIMESTAMP '2024-01-20') - max(epoch_us(e.ts))) / 3600000000.0 AS age
      FROM d LEFT JOIN events e ON e.event_type = d.name AND e.ts <= TIMESTAMP '2024-01-20'
      GROUP BY ALL)
SELECT name, 'freshness_hours' AS metric, round(age, 6) AS value,
       CASE WHEN age IS NULL OR age > allowed THEN 'alert' ELSE 'ok' END AS status,
       CASE WHEN age IS NULL THEN 'no values at all'
            ELSE format('newest values are {:.1f} hours old, allowed {}', age, allowed) END
           AS message
FROM a""",
    name="freshness",
)
def feature_freshness(spark, folder):
    values = observations(spark, folder, ["purchase", "view", "click"])
    return freshness_checks(definitions_frame(spark, _FRESH), values, AS_OF)


def _edges_sql(rows: str, bins: int = 10) -> str:
    """Quantile edges by whole-number ranks, and the shares between them."""
    return f"""
p AS (SELECT feature_name, value, row_number() OVER w - 1 AS pos, count(*) OVER (
          PARTITION BY feature_name) - 1 AS m FROM {rows} WHERE value IS NOT NULL
      WINDOW w AS (PARTITION BY feature_name ORDER BY value)),
k AS (SELECT DISTINCT feature_name, m, CAST(k AS BIGINT) AS k
      FROM p CROSS JOIN range(1, {bins}) g(k) WHERE m >= 1),
e AS (SELECT k.feature_name, list_sort(list_distinct(list(
             (lo.value * ({bins} - (k * k.m) % {bins}) + coalesce(hi.value, lo.value)
              * ((k * k.m) % {bins})) / {bins}.0::DOUBLE))) AS edges
      FROM k JOIN p lo ON lo.feature_name = k.feature_name AND lo.pos = (k * k.m) // {bins}
      LEFT JOIN p hi ON hi.feature_name = k.feature_name AND hi.pos = (k * k.m) // {bins} + 1
      GROUP BY k.feature_name)"""


def _shares_sql(name: str, rows: str) -> str:
    return f"""
{name}_b AS (SELECT e.feature_name, CASE WHEN x.value IS NULL THEN len(e.edges) + 1
             ELSE len(list_filter(e.edges, lambda z: z < x.value)) END AS bin, count(*) AS n
             FROM e JOIN {rows} x USING (feature_name) GROUP BY ALL),
{name} AS (SELECT e.feature_name, i AS bin, coalesce(n, 0) / sum(n) OVER (
                  PARTITION BY e.feature_name) AS share
           FROM (SELECT feature_name, edges, unnest(range(0, len(edges) + 2)) AS i FROM e) e
           LEFT JOIN {name}_b b ON b.feature_name = e.feature_name AND b.bin = i)"""


def exploded_bins(reference: DataFrame) -> DataFrame:
    """A distribution as one row per bin, to compare it with SQL."""
    bins = F.posexplode("shares").alias("bin", "share")
    return reference.select("feature_name", "edges", bins).select(
        "feature_name",
        F.col("bin").cast("bigint").alias("bin"),
        F.get("edges", "bin").alias("upper_edge"),
        "share",
    )


@query(
    f"""{TRADE_MONTHS}, {LONG_SQL}, {_edges_sql("long")}, {_shares_sql("shares", "long")}
SELECT shares.feature_name, bin, round(e.edges[bin + 1], 6) AS upper_edge, round(share, 6) AS share
FROM shares JOIN e USING (feature_name)"""
)
def drift_reference(spark, folder):
    return exploded_bins(reference_distribution(daily_values(from_trade(spark, folder), MONTHS)))


# The distribution of the values of all days of the events.
DISTRIBUTION_SQL = f"""{EVENT_DAYS}, {LONG_SQL}, {_edges_sql("long")}, {_shares_sql("shares", "long")}
SELECT shares.feature_name, bin, round(e.edges[bin + 1], 6) AS upper_edge, round(share, 6) AS share
FROM shares JOIN e USING (feature_name)"""


@query(DISTRIBUTION_SQL)
def drift_reference_sliced(spark, folder):
    """The same kind of distribution with ranks added up over about ten slices of the values."""
    values = cut(daily_values(from_events(spark, folder)))
    return exploded_bins(reference_distribution(values, slices=10))


def psi_sql(before: str, today: str) -> str:
    """The index of the values `long` at some moments against those at others (conditions)."""
    return f"""
before AS (SELECT * FROM long WHERE {before}),
today AS (SELECT * FROM long WHERE {today}),
{_edges_sql("before")}, {_shares_sql("old", "before")}, {_shares_sql("new", "today")},
psi AS (SELECT feature_name,
        sum((greatest(new.share, 1e-4) - greatest(old.share, 1e-4))
            * ln(greatest(new.share, 1e-4) / greatest(old.share, 1e-4))) AS psi
        FROM old JOIN new USING (feature_name, bin) GROUP BY feature_name),
drift AS (SELECT feature_name AS name, 'psi' AS metric, psi AS value,
       CASE WHEN psi >= 0.25 THEN 'alert' WHEN psi >= 0.1 THEN 'warning' ELSE 'ok' END AS status,
       format('PSI {{:.3f}} against the model''s training data '
              '(warning from 0.1, alert from 0.25)', psi) AS message
       FROM psi)"""


_PSI_SQL = f"""{EVENT_DAYS}, {LONG_SQL}, {psi_sql(
    "event_timestamp <= TIMESTAMP '2024-01-10'", "event_timestamp = TIMESTAMP '2024-01-25'"
)}"""


def _reference_and_today(spark, folder):
    values = daily_values(from_events(spark, folder))
    before = values.where(F.col("event_timestamp") <= F.lit(AS_OF - timedelta(days=10)))
    today = values.where(F.col("event_timestamp") == F.lit(AS_OF + timedelta(days=5)))
    return reference_distribution(before), today


@query(f"{_PSI_SQL} SELECT feature_name, round(psi, 6) AS psi FROM psi")
def drift_psi(spark, folder):
    reference, today = _reference_and_today(spark, folder)
    return stability_index(reference, value_counts(today))


@query(
    f"""{_PSI_SQL} SELECT name, metric, round(value, 6) AS value, status, message FROM drift""",
    name="drift_checks",
)
def snapshot_drift_checks(spark, folder):
    reference, today = _reference_and_today(spark, folder)
    return drift_checks(reference, today, AS_OF + timedelta(days=5))


_LOG_DAYS = [midnight(AS_OF.replace(day=day).date()) for day in (5, 12, 20, 26)]
_LOG_MOMENTS = ", ".join(f"TIMESTAMP '{day:%Y-%m-%d}'" for day in _LOG_DAYS)
_LOG_SQL = f"""{quality_sql(_LOG_MOMENTS)},
latest AS (SELECT name, metric, max(event_timestamp) AS snapshot_at,
                  arg_max_null(value, event_timestamp) AS value,
                  arg_max(status, event_timestamp) AS status,
                  arg_max(message, event_timestamp) AS message
           FROM checks WHERE event_timestamp <= TIMESTAMP '2024-01-21' GROUP BY ALL),
by_name AS (SELECT name, max(CASE status WHEN 'alert' THEN 2 WHEN 'warning' THEN 1 ELSE 0 END)
                       AS code,
                   count(*) AS n_checks FROM latest GROUP BY name)"""


def _log(spark, folder) -> DataFrame:
    """The quality checks of several days, as the monitor log holds them."""
    definitions = definitions_frame(spark, DEFINITIONS)
    values = cut(daily_values(from_events(spark, folder), _LOG_DAYS))
    days = [
        quality_checks(definitions, values.where(F.col("event_timestamp") == F.lit(day)), day)
        .withColumn("snapshot_at", F.lit(day))
        for day in _LOG_DAYS
    ]
    return reduce(DataFrame.unionByName, days).withColumn("kind", F.lit("feature"))


def _outcomes(spark, folder) -> DataFrame:
    return latest_outcomes(_log(spark, folder), AS_OF + timedelta(days=1))


@query(
    f"""{_LOG_SQL} SELECT 'feature' AS kind, name, metric, snapshot_at, round(value, 6) AS value,
       status, message FROM latest"""
)
def latest_check_outcomes(spark, folder):
    return _outcomes(spark, folder)


@query(
    f"""{_LOG_SQL} SELECT 'feature' AS kind, name, n_checks,
       CASE code WHEN 2 THEN 'alert' WHEN 1 THEN 'warning' ELSE 'ok' END AS status FROM by_name""",
    name="status_by_name",
)
def status_per_name(spark, folder):
    return status_by_name(_outcomes(spark, folder)).select(
        "kind", "name", "status", F.size("checks").cast("bigint").alias("n_checks")
    )


@query(
    f"""{_LOG_SQL} SELECT CASE max(code) WHEN 2 THEN 'alert' WHEN 1 THEN 'warning' ELSE 'ok' END
       AS status FROM by_name"""
)
def status_overall(spark, folder):
    return overall_status(cut(status_by_name(_outcomes(spark, folder))))

