from datetime import UTC, datetime

import pytest
from pyspark.sql import SparkSession

from tidemark.plans.store import FeatureStore
from tidemark.session import prepare

VALUES = "feature_name string, entity_id bigint, event_timestamp timestamp, value double"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tidemark-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", str(folder / "checkpoints"))
        .config("spark.sql.warehouse.dir", str(folder / "warehouse"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield prepare(session)
    session.stop()


@pytest.fixture
def store(spark, tmp_path):
    return FeatureStore(spark, str(tmp_path / "store"))


def day(number, hour=0, month=3):
    return datetime(2026, month, number, hour, tzinfo=UTC)


def long_values(spark, rows):
    """(feature, entity, moment, value) rows as long values."""
    return spark.createDataFrame(rows, VALUES)


def put(store, view_name, rows, now=None):
    """Store (feature, entity, moment, value) rows."""
    from pyspark.sql import functions as F

    frame = long_values(store.spark, rows).withColumn("view_name", F.lit(view_name))
    return store.values.upsert(frame, now)


def rows_of(frame, *columns):
    selected = frame.select(*columns) if columns else frame
    return [tuple(row) for row in selected.collect()]
