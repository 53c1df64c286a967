"""Model versions on disk and which of them is the champion."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources import schemas
from tidemark.sources.tables import CommitLog, exists, nullable

_VERSIONS = T.StructType(
    [
        T.StructField("promoted", T.BooleanType()),
        T.StructField("has_reference", T.BooleanType()),
        T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType())),
        T.StructField("params", T.MapType(T.StringType(), T.StringType())),
    ]
)


@dataclass(frozen=True)
class ModelVersion:
    """What is recorded about a version; the model itself is loaded with `pipeline()`."""

    name: str
    version: str
    path: str
    metrics: dict[str, float]
    params: dict[str, str]
    reference: DataFrame | None

    @property
    def test_roc_auc(self) -> float | None:
        return self.metrics.get("roc_auc")

    def pipeline(self) -> PipelineModel:
        return PipelineModel.load(f"{self.path}/pipeline")


class ModelStore:
    """Numbered versions per model name. The champion is the last version that was promoted."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = f"{root}/models"

    def _log(self, name: str) -> CommitLog:
        return CommitLog(self.spark, f"{self.root}/{name}/versions", _VERSIONS)

    def _path(self, name: str, version: int) -> str:
        return f"{self.root}/{name}/v={version}"

    def save(
        self, name: str, pipeline: PipelineModel, reference: DataFrame | None = None
    ) -> tuple[int, PipelineModel]:
        """Write a model and its drift reference; returns its number and the model read back.

        The version does not exist for readers before it is registered.
        """
        version = self._log(name).next_version()
        path = self._path(name, version)
        pipeline.write().overwrite().save(f"{path}/pipeline")
        if reference is not None:
            reference.select(*schemas.DRIFT_REFERENCE.names).coalesce(1).write.mode(
                "overwrite"
            ).parquet(f"{path}/drift_reference")
        return version, PipelineModel.load(f"{path}/pipeline")

    def register(
        self,
        name: str,
        version: int,
        metrics: dict[str, float],
        params: dict[str, str],
        promoted: bool,
    ) -> str:
        """Record a saved version and whether it becomes the champion."""
        has_reference = exists(self.spark, f"{self._path(name, version)}/drift_reference")
        self._log(name).commit(
            version,
            promoted=promoted,
            has_reference=has_reference,
            metrics=metrics,
            params=params,
        )
        return str(version)

    def champion(self, name: str) -> ModelVersion | None:
        """The version in use, without loading the model; None before the first promotion."""
        row = self._log(name).last(F.col("promoted"))
        return None if row is None else self._version(name, row)

    def versions(self, name: str) -> DataFrame:
        return self._log(name).rows()

    def _version(self, name: str, row: dict) -> ModelVersion:
        path = self._path(name, row["version"])
        reference = None
        if row["has_reference"]:
            reference = self.spark.read.schema(nullable(schemas.DRIFT_REFERENCE)).parquet(
                f"{path}/drift_reference"
            )
        return ModelVersion(
            name, str(row["version"]), path, row["metrics"], row["params"], reference
        )
