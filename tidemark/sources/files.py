"""Training sets as CSV with a header."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.sources import schemas


def training_schema(features: Sequence[str]) -> T.StructType:
    return T.StructType(
        [
            T.StructField("entity_id", schemas.LONG),
            T.StructField("event_timestamp", schemas.TIMESTAMP),
            *[T.StructField(name, schemas.DOUBLE) for name in features],
            T.StructField("label", schemas.INT),
        ]
    )


def write_training_csv(training: DataFrame, path: str) -> None:
    training.write.mode("overwrite").option("header", True).csv(path)


def read_training_csv(spark: SparkSession, path: str, features: Sequence[str]) -> DataFrame:
    return spark.read.schema(training_schema(features)).option("header", True).csv(path)
