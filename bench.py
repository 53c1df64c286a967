"""Time the headline queries on the supplied tables; prints one JSON line.

BENCH_SF_DIR names the folder of the tables, BENCH_CPUS the number of local cores. Every query is
run twice to warm up and then timed, writing its whole result to a sink that drops it.
"""

from __future__ import annotations

import json
import os
import sys
import time
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.catalog import QUERIES
from tidemark.catalog.base import MONTHS, daily_values, work_folder
from tidemark.plans.historical import features_at
from tidemark.plans.purchase_stats import FEATURES
from tidemark.session import SETTINGS
from tidemark.sources.adapters import from_trade

HEADLINE = [
    "purchase_stats_asof",
    "backfill_daily",
    "purchase_stats_monthly",
    "labels_next_window",
    "pit_join",
    "pit_join_shipments",
    "pit_join_daily_values",
    "training_set",
    "latest_values_map",
    "online_enrich",
    "quality_checks",
    "integrity_checks",
    "drift_reference",
    "roc_auc_rank",
    "upsert_changes",
]


def session() -> SparkSession:
    cores = os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tidemark-bench")
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def run(frame: DataFrame) -> None:
    frame.write.format("noop").mode("overwrite").save()


def timed(make) -> float:
    for _ in range(2):
        run(make())
    started = time.perf_counter()
    run(make())
    return time.perf_counter() - started


def stored_point_in_time(spark: SparkSession, folder: str):
    """The point-in-time join as published for comparison: a large store, 11,000 training rows.

    The store holds monthly values of all customers in daily partitions, written once; the
    requests are customers drawn from all months, each one day after a snapshot.
    """
    path = work_folder(spark)
    values = daily_values(from_trade(spark, folder), MONTHS)
    values.repartition("snapshot_date").write.partitionBy("snapshot_date").parquet(f"{path}/values")
    stored = spark.read.parquet(f"{path}/values")
    # One customer in some, so that about 11,000 rows are spread over all months
    asked = stored.where("feature_name = 'view_count_7d'")
    every = max(1, asked.count() // 11_346)
    rows = (
        asked.where(F.pmod(F.xxhash64("entity_id", "event_timestamp"), F.lit(every)) == 0)
        .select(
            "entity_id",
            (F.col("event_timestamp") + F.expr("interval 1 day")).alias("event_timestamp"),
        )
        .withColumn("row_id", F.monotonically_increasing_id())
    )
    rows.write.parquet(f"{path}/requests")
    requests = spark.read.parquet(f"{path}/requests")
    ttls = dict.fromkeys(FEATURES, timedelta(days=2))
    return lambda: features_at(requests, stored, ttls)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session()
    wanted = sys.argv[1:]
    seconds = {
        name: round(timed(lambda name=name: QUERIES[name](spark, folder)), 3)
        for name in wanted or HEADLINE
    }
    if not wanted:
        seconds["pit_join_stored"] = round(timed(stored_point_in_time(spark, folder)), 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")),
            }
        )
    )


if __name__ == "__main__":
    main()
