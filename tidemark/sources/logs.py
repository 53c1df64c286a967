"""The monitor log (check outcomes) and the prediction log."""

from __future__ import annotations

import time
from datetime import UTC, date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources import schemas
from tidemark.sources.tables import nullable, read_or_empty

KINDS = ("feature", "model")
_KEY = ["kind", "name", "metric", "snapshot_at"]


class MonitorLog:
    """One row per thing checked, metric and snapshot; a repeated check replaces its row.

    Checks are only ever added, numbered in the order they were logged; readers take the last of
    each. Nothing that was logged is written again, so a lost writer loses nothing.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.path = f"{root}/monitor_logs"
        self.schema = T.StructType(
            [*nullable(schemas.MONITOR_LOG).fields, T.StructField("entry", T.LongType())]
        )

    def read(self) -> DataFrame:
        entries = read_or_empty(self.spark, self.path, self.schema)
        columns = [name for name in self.schema.names if name not in [*_KEY, "entry"]]
        last = F.max_by(F.struct(*columns), "entry").alias("last")
        return entries.groupBy(*_KEY).agg(last).select(*_KEY, "last.*").select(
            *schemas.MONITOR_LOG.names
        )

    def log(
        self, kind: str, snapshot_at: datetime, checks: DataFrame, now: datetime | None = None
    ) -> None:
        if kind not in KINDS:
            raise ValueError(f"kind must be one of {KINDS}, not '{kind}'")
        new = checks.select(
            F.lit(kind).alias("kind"),
            "name",
            "metric",
            F.lit(snapshot_at).alias("snapshot_at"),
            "value",
            "status",
            "message",
            F.lit(now or datetime.now(UTC)).alias("checked_at"),
            F.lit(time.time_ns()).alias("entry"),
        )
        new.coalesce(1).write.mode("append").parquet(self.path)


class PredictionLog:
    """Every prediction with the feature values the model saw.

    A batch is written to its own folder, named by the job and the batch: writing the same batch
    again, after a failure or a replayed stream, replaces it and logs nothing twice.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.path = f"{root}/predictions"

    def write(self, predictions: DataFrame, job: str, batch: int) -> None:
        columns = [field.name for field in schemas.PREDICTIONS.fields]
        predictions.select(*columns, F.to_date("predicted_at").alias("day")).write.mode(
            "overwrite"
        ).option("partitionOverwriteMode", "static").partitionBy("day").parquet(
            f"{self.path}/job={job}/batch={batch}"
        )

    def read(self) -> DataFrame:
        columns = [*nullable(schemas.PREDICTIONS).fields]
        places = [
            T.StructField("job", T.StringType()),
            T.StructField("batch", T.LongType()),
            T.StructField("day", T.DateType()),
        ]
        return read_or_empty(self.spark, self.path, T.StructType([*columns, *places]))

    def between(self, model_name: str, first: date, last: date) -> DataFrame:
        """What was predicted on some days; only those are read."""
        return self.read().where(
            (F.col("model_name") == model_name) & F.col("day").between(F.lit(first), F.lit(last))
        )
