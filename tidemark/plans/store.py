"""Everything that lives under one root folder."""

from __future__ import annotations

from pyspark.sql import SparkSession

from tidemark.session import prepare
from tidemark.sources.logs import MonitorLog, PredictionLog
from tidemark.sources.models import ModelStore
from tidemark.sources.online import OnlineStore
from tidemark.sources.raw import RawTables
from tidemark.sources.registry import FeatureRegistry
from tidemark.sources.values import ValueStore


class FeatureStore:
    """Raw tables, registry, values, published rows, logs and models of one project."""

    def __init__(self, spark: SparkSession, root: str, shuffled_bytes: int | None = None):
        self.spark = prepare(spark, shuffled_bytes)
        self.root = root
        self.raw = RawTables(spark, root)
        self.registry = FeatureRegistry(spark, root)
        self.values = ValueStore(spark, root)
        self.online = OnlineStore(spark, root)
        self.monitor = MonitorLog(spark, root)
        self.predictions = PredictionLog(spark, root)
        self.models = ModelStore(spark, root)
